"""Aggregating and joining around skewed keys; partition and file layout reports.

Assume one key may hold a third of all rows.  The operators here never send a hot
key whole to one task:

* ``salted_agg``: (key, salt) partial groups, then key.  Only decomposable
  aggregates (sum, count, min, max, avg as sum + count) are accepted.
* ``salted_join``: the big side's hot keys get a salt from a hash of a row id; the
  small side's rows of these keys are replicated once per salt value.
* ``hot_key_join``: the same, with the hot keys found on the way.
* ``preagg_join``: aggregate to the join key before joining, so the shuffle moves
  one row per key instead of one per fact.

Salts come from ``xxhash64`` of columns that the caller names as telling rows apart,
never from ``rand()`` or row ids that change when a task is retried.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelab.functions import col_of

DECOMPOSABLE = ("sum", "count", "min", "max", "avg")
#: Hot keys that are broadcast at most: some MB.
MAX_HOT = 100_000
JOIN_TYPES = ("inner", "left", "left_semi", "left_anti")


@dataclass(frozen=True)
class Agg:
    """An output column ``name`` = ``func(col)``; ``col`` may be any expression
    (cast to decimal for order-independent sums)."""

    name: str
    func: str
    col: str | Column = "*"


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _check_aggs(aggs: Sequence[Agg]) -> None:
    for a in aggs:
        if a.func not in DECOMPOSABLE:
            raise ValueError(f"{a.func} is not decomposable; salting supports {', '.join(DECOMPOSABLE)}")


def _value(a: Agg) -> Column:
    return F.lit(1) if (isinstance(a.col, str) and a.col == "*") else col_of(a.col)


def _partial(aggs: Sequence[Agg]) -> list[Column]:
    out = []
    for i, a in enumerate(aggs):
        v = _value(a)
        if a.func == "sum":
            out.append(F.sum(v).alias(f"__p{i}"))
        elif a.func == "count":
            out.append(F.count(v).alias(f"__p{i}"))
        elif a.func == "min":
            out.append(F.min(v).alias(f"__p{i}"))
        elif a.func == "max":
            out.append(F.max(v).alias(f"__p{i}"))
        else:  # avg
            out += [F.sum(v).alias(f"__p{i}"), F.count(v).alias(f"__c{i}")]
    return out


def _final(aggs: Sequence[Agg]) -> list[Column]:
    out = []
    for i, a in enumerate(aggs):
        p = F.col(f"__p{i}")
        if a.func == "sum":
            out.append(F.sum(p).alias(a.name))
        elif a.func == "count":
            out.append(F.sum(p).cast("long").alias(a.name))
        elif a.func == "min":
            out.append(F.min(p).alias(a.name))
        elif a.func == "max":
            out.append(F.max(p).alias(a.name))
        else:
            # avg is returned as double: sum / count of the partial sums and counts.
            out.append((F.sum(p).cast("double") / F.sum(F.col(f"__c{i}"))).alias(a.name))
    return out


def row_salt(n: int, cols: Sequence[str], seed: int = 17) -> Column:
    """Salt in [0, n) from a hash of ``cols``, which should tell the rows of a key apart
    (a row id); stable under task retries."""
    if n < 1 or not cols:
        raise ValueError("a salt needs n >= 1 and at least one column that tells rows apart")
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in cols], F.lit(seed)), F.lit(n)).cast("int")


def salted_agg(
    df: DataFrame, keys: str | Sequence[str], aggs: Sequence[Agg], salt_cols: Sequence[str], n: int = 16
) -> DataFrame:
    """Two-level aggregate: by (keys, salt) then by keys.  Equal to the plain
    ``groupBy(keys).agg(...)`` for every ``n``; only keys, inputs and ``salt_cols`` are read.

    The engine's own partial aggregation already sends one row per key and task, so this
    pays only where a map task holds so many keys that its partial results spill."""
    keys = _names(keys)
    _check_aggs(aggs)
    salted = df.withColumn("__salt", row_salt(n, salt_cols))
    partial = salted.groupBy(*keys, "__salt").agg(*_partial(aggs))
    return partial.groupBy(*keys).agg(*_final(aggs))


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: str | Sequence[str],
    salt_cols: Sequence[str],
    n: int = 16,
    how: str = "inner",
    hot_keys: DataFrame | None = None,
    hot_bound: int | None = None,
) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys`` with the big side's hot keys spread over ``n`` salts.

    ``hot_keys``: a DataFrame of key values, all of which are salted on the big side and
    replicated on the small one; other keys keep salt 0, so ``small`` is not copied as a
    whole.  The list is broadcast: joined by a shuffle, it would bring every row of a hot key
    to one task before it has a salt.  ``hot_bound`` is how many keys it provably has at
    most (``1 / threshold`` for ``hot_keys``); without it the list is counted, the one job
    this function runs.  Beyond ``MAX_HOT`` keys, and without a list, every key is salted.
    Rows with a null key match nothing and are spread as well.
    ``how`` is inner, left (big side preserved), left_semi or left_anti; outer joins
    preserving ``small`` are rejected because its replicas would repeat.
    """
    keys = _names(keys)
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {JOIN_TYPES}; right/full outer would repeat replicated rows")
    salt = row_salt(n, salt_cols)
    replicas = F.sequence(F.lit(0), F.lit(n - 1))
    if hot_keys is not None and hot_bound is None:
        hot_bound = hot_keys.select(*keys).distinct().limit(MAX_HOT + 1).count()
    if hot_keys is not None and hot_bound <= MAX_HOT:
        hot = F.broadcast(hot_keys.select(*keys).distinct().withColumn("__hot", F.lit(True)))
        big = big.join(hot, keys, "left")
        small = small.join(hot, keys, "left")
        null_key = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
        salt = F.when(F.col("__hot") | null_key, salt).otherwise(F.lit(0))
        replicas = F.when(F.col("__hot"), replicas).otherwise(F.array(F.lit(0)))
    big_s = big.withColumn("__salt", salt).drop("__hot")
    small_s = small.withColumn("__salt", F.explode(replicas)).drop("__hot")
    return big_s.join(small_s, keys + ["__salt"], how).drop("__salt")


def hot_keys(df: DataFrame, keys: str | Sequence[str], threshold: float = 0.01) -> DataFrame:
    """The keys holding at least ``threshold`` of all rows, nulls left out: at most
    ``1 / threshold`` of them, whatever the data.  One aggregate pass over the keys."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    keys = _names(keys)
    freq = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = freq.agg(F.sum("__n").alias("__total")).select("__total").scalar()
    not_null = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    return freq.where(not_null & (F.col("__n") >= total * F.lit(threshold))).select(*keys)


def hot_key_join(
    big: DataFrame,
    small: DataFrame,
    keys: str | Sequence[str],
    salt_cols: Sequence[str],
    threshold: float = 0.01,
    how: str = "inner",
    n: int = 64,
) -> DataFrame:
    """A salted join whose hot keys are found on the way, all in one lazy plan.

    The keys with at least ``threshold`` of the rows (``hot_keys``) are broadcast: there
    can be no more than ``1 / threshold`` of them.  The big side is read once for its keys
    and once for the join, and no job runs before the result is used.  ``how`` is inner
    or left (big side preserved)."""
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    keys = _names(keys)
    return salted_join(big, small, keys, salt_cols, n, how, hot_keys(big, keys, threshold), math.ceil(1 / threshold))


def preagg_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    aggs: Sequence[Agg],
    group_cols: Sequence[str],
) -> DataFrame:
    """``fact ⋈ dim`` grouped by ``group_cols`` (columns of ``dim``), computed as
    aggregate-to-key → join → roll up.  The join then shuffles one row per key."""
    _check_aggs(aggs)
    pre = fact.groupBy(F.col(fact_key).alias("__k")).agg(*_partial(aggs))
    joined = pre.join(dim, pre["__k"] == dim[dim_key])
    return joined.groupBy(*group_cols).agg(*_final(aggs))


# --- layout reports -------------------------------------------------------------------


_FIXED_BYTES = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4, "bigint": 8, "double": 8,
                "timestamp": 8, "timestamp_ntz": 8}


def _row_bytes(df: DataFrame) -> Column:
    """Approximate bytes of a row: fixed widths, string / binary lengths, 16 per other value."""
    parts = []
    for f in df.schema.fields:
        name = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if name in _FIXED_BYTES:
            parts.append(F.lit(_FIXED_BYTES[name]))
        elif name in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        else:
            parts.append(F.lit(16))
    return reduce(lambda a, b: a + b, parts, F.lit(0)).cast("long")


def partition_balance(df: DataFrame) -> DataFrame:
    """partition, rows, bytes (approximate), share_of_max for the current
    partitioning of ``df``: one pass, one row per partition."""
    per = df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")
    )
    # One row per partition: a window over it is bounded by the partition count.  (A
    # scalar subquery would run the input again: partition ids are not reusable.)
    biggest = F.max("rows").over(Window.partitionBy())
    return per.select("partition", "rows", "bytes", (F.col("rows") / biggest).alias("share_of_max"))


def balance_by_range(df: DataFrame, keys: str | Sequence[str], n: int | None = None) -> DataFrame:
    """Range partitioning (sampled bounds) on ``keys`` into ``n`` partitions, or as many as
    the engine finds right for the size."""
    cols = [F.col(k) for k in _names(keys)]
    return df.repartitionByRange(n, *cols) if n else df.repartitionByRange(*cols)


def file_layout(df: DataFrame, small_bytes: int = 32 << 20, fat_bytes: int = 1 << 30) -> DataFrame:
    """file_path, file_name, size_bytes, rows, small_file, fat_file for a file-based
    DataFrame (the hidden ``_metadata`` column; nothing but it is read)."""
    per = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size").agg(
        F.count(F.lit(1)).alias("rows")
    )
    return per.select(
        "file_path",
        F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
        F.col("file_size").alias("size_bytes"),
        "rows",
        (F.col("file_size") < small_bytes).alias("small_file"),
        (F.col("file_size") > fat_bytes).alias("fat_file"),
    )
