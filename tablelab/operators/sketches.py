"""Stored, mergeable column profiles and heavy hitters in bounded memory.

A profile is a row per part of a table (a day, a file, an append) and column: exact
counts, least and greatest value, and three sketches as binary columns.

* ``distinct``: HyperLogLog, 2 ** 12 registers: standard error 1.6 %.
* ``keys``: a theta sketch of 2 ** 12 hashes: 1.6 % for distinct counts, and set operations.
* ``quantiles``: KLL with k = 200: a rank is off by 1.7 % at most (99 % of the time).

Rows are written once, when a part arrives, by one scan with partial aggregation.  The
profile of any set of parts is the merge of their rows; the data isn't read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.operators.profile import _NUMERIC, _names, _orderable, _percentile_name

LOG_K = 12
#: Rank error of a quantile (KLL, k = 200) and relative error of a distinct count, at three standard errors.
RANK_ERROR, DISTINCT_ERROR = 0.025, 0.05


def profile_parts(df: DataFrame, cols: Sequence[str] | None = None, by: str | Sequence[str] = ()) -> DataFrame:
    """A row per part (values of ``by``) and column: ``column_name, n, nulls, min_value,
    max_value, distinct, keys, quantiles``.

    Nulls are counted and in no sketch; a column without an order (map, variant) has neither least
    nor greatest value; columns that aren't numbers have no quantiles.  Without rows there
    are no parts, or one of zeros if ``by`` is empty.
    """
    by = _names(by)
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in by]
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs, rows = [], []
    for i, c in enumerate(cols):
        value, numeric = F.col(f"`{c}`"), isinstance(types[c], _NUMERIC)
        ordered = _orderable(types[c])
        hashed = F.when(value.isNotNull(), F.xxhash64(value if ordered else F.to_json(value)))
        aggs += [
            F.count(value).alias(f"n{i}"), F.count_if(value.isNull()).alias(f"z{i}"),
            F.hll_sketch_agg(hashed, LOG_K).alias(f"d{i}"), F.theta_sketch_agg(hashed, LOG_K).alias(f"t{i}"),
        ]
        if ordered:
            aggs += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
        if numeric:
            aggs.append(F.kll_sketch_agg_double(value.cast("double")).alias(f"q{i}"))
        text = lambda name: F.col(name).cast("string") if ordered else F.lit(None).cast("string")
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"z{i}").alias("nulls"), text(f"lo{i}").alias("min_value"),
            text(f"hi{i}").alias("max_value"), F.lit(numeric).alias("numeric"), F.col(f"d{i}").alias("distinct"), F.col(f"t{i}").alias("keys"),
            (F.col(f"q{i}") if numeric else F.lit(None).cast("binary")).alias("quantiles"),
        ))
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*rows)))


def merge_profiles(parts: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Rows of ``profile_parts`` as one row per column, or per column and ``by``; nothing else is read.

    Least and greatest values of numbers are compared as numbers, others as text."""
    by = _names(by)
    numeric = F.col("numeric")
    out = []
    for name, f, pick in (("min_value", F.min, F.min_by), ("max_value", F.max, F.max_by)):
        value, order = F.col(name), F.when(numeric, F.col(name).try_cast("double"))
        out.append(F.coalesce(pick(value, order), f(value)).alias(name))
    return parts.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), *out, F.max("numeric").alias("numeric"),
        F.hll_union_agg("distinct").alias("distinct"), F.theta_union_agg("keys", LOG_K).alias("keys"),
        F.when(F.max("numeric"), F.kll_merge_agg_double("quantiles")).alias("quantiles"),
    )


def figures(profiles: DataFrame, percentiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Profiles with ``approx_distinct`` and a column for each percentile in place of the sketches."""
    some = F.col("quantiles").isNotNull() & (F.col("n") > 0)
    asked = [F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(_percentile_name(p)) for p in percentiles]
    rest = [c for c in profiles.columns if c not in ("distinct", "keys", "quantiles", "numeric")]
    return profiles.select(*rest, F.hll_sketch_estimate("distinct").alias("approx_distinct"), *asked)


def shared_keys(a: Column, b: Column) -> Column:
    """How many distinct values two theta sketches have in common, about."""
    return F.theta_sketch_estimate(F.theta_intersection(a, b))


def new_keys(a: Column, b: Column) -> Column:
    """How many distinct values of ``b`` aren't in ``a``, about."""
    return F.theta_sketch_estimate(F.theta_difference(b, a))


def frequent_keys(df: DataFrame, keys: str | Sequence[str], threshold: float = 0.01) -> DataFrame:
    """``(keys..., n)``: the keys holding at least ``threshold`` of all rows, nulls left out, exactly.

    The same keys as ``skew.hot_keys``, without a shuffle of a row per key.  The first pass
    keeps a counter summary of ``8 / threshold`` keys a task (frequent items); its counts are
    too high by less than a third of ``threshold``, so every wanted key is among the
    ``2 / threshold`` largest.  The second pass counts these candidates alone; they are broadcast,
    as there are no more of them.  Rows with a null in any key count in the total only.
    """
    if not 0.0001 <= threshold <= 1:
        raise ValueError("threshold must be in [0.0001, 1]")
    keys = _names(keys)
    most, tracked = int(2 / threshold) + 1, int(8 / threshold) + 1
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(f"`{k}`").isNotNull()
    # One text for all columns of the key; a summary holds values of one plain type.
    code = F.when(whole, F.to_json(F.array(*[F.col(f"`{k}`").cast("string") for k in keys])))
    coded = df.select(code.alias("__code"), *[F.col(f"`{k}`") for k in keys])
    first = coded.agg(F.count(F.lit(1)).alias("total"), F.call_function("approx_top_k", F.col("__code"), F.lit(most), F.lit(tracked)).alias("top"))
    wanted = first.select("total", F.explode("top").alias("c")).select(F.col("c.item").alias("__code"), "total").where("__code is not null")
    counted = coded.join(F.broadcast(wanted), "__code").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("total").alias("total"))
    return counted.where(F.col("n") >= F.col("total") * F.lit(threshold)).drop("total")
