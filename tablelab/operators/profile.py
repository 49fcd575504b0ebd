"""Profiles: key frequency and skew, one-scan column profiles, ordered top, top-k per key.

Scale notes
-----------
* Every profile is an aggregate with partial (map-side) aggregation; nothing is
  collected to the driver.
* Ranks never use a window over an unbounded set: the top-N path uses
  TakeOrderedAndProject (bounded), the all-keys path ranks through the histogram
  of counts, whose size is provably at most sqrt(2 * rows) (the distinct counts
  n_1 < n_2 < ... of k keys need at least k(k+1)/2 rows).
* ``topk_per_key`` relies on Spark's WindowGroupLimit, which trims every map
  partition to k rows per key before the shuffle, and for a large k on ranking parts of
  a key first, so a hot key holding a third of the data never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.functions import col_of, exact_avg

SALTS = 32  # parts of a key ranked apart where k is too large for the engine's own limit
SKEW_SHARE_THRESHOLD = 0.7  # a key holding more than this share of rows is "skewed"


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def key_frequency(df: DataFrame, keys: str | Sequence[str], top: int | None = None) -> DataFrame:
    """Rows per key, share of all rows, rank by frequency and ratio to the mean key.

    Returns ``keys..., n, share, rank, ratio_to_mean``; ``rank`` is SQL ``rank()``
    (ties share a rank).  All keys are returned unless ``top`` asks for the ``top`` most
    frequent ones (ties broken by key).
    """
    keys = _names(keys)
    freq = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = freq.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_keys"))
    total = totals.select("total").scalar()
    n_keys = totals.select("n_keys").scalar()

    if top is not None:
        if top <= 0:
            raise ValueError("top must be positive")
        order = [F.col("n").desc()] + [F.col(k).asc_nulls_last() for k in keys]
        head = freq.orderBy(*order).limit(top)
        # The window runs over at most `top` rows.
        ranked = head.withColumn("rank", F.rank().over(Window.orderBy(F.col("n").desc())))
    else:
        # rank(n) = 1 + number of keys with a larger count, from the histogram of counts.
        hist = freq.groupBy("n").agg(F.count(F.lit(1)).alias("keys_with_n"))
        above = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.select("n", (F.coalesce(F.sum("keys_with_n").over(above), F.lit(0)) + 1).alias("rank"))
        # Bounded by sqrt(2 * rows) (see module doc), so broadcasting is safe at any size.
        ranked = freq.join(F.broadcast(hist), "n")

    return ranked.select(
        *keys,
        "n",
        (F.col("n") / total).alias("share"),
        F.col("rank").cast("long").alias("rank"),
        # double product: n * n_keys can pass 2^63 when one key holds ~1e11 rows.
        (F.col("n").cast("double") * n_keys.cast("double") / total).alias("ratio_to_mean"),
    )


def skew_ratio(df: DataFrame, key: str | Column, value, threshold: float = SKEW_SHARE_THRESHOLD) -> DataFrame:
    """Share of rows where ``key == value``, in one pass: hits, total, ratio, skewed."""
    hit = F.when(col_of(key) == F.lit(value), 1).otherwise(0)
    out = df.agg(F.sum(hit).cast("long").alias("hits"), F.count(F.lit(1)).alias("total"))
    ratio = (F.col("hits") / F.col("total")).alias("ratio")
    return out.select("hits", "total", ratio, (ratio > F.lit(threshold)).alias("skewed"))


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


_FIXED_WIDTH = _NUMERIC + (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def global_profile(df: DataFrame, cols: Sequence[str] | None = None, exact_scale: int | None = None) -> DataFrame:
    """Per column n (non-null), nulls, min, max and mean, as aggregates without a shuffle
    of rows (partial aggregation, one row per task to the final step).

    Returns a long table ``column_name, n, nulls, min_value, max_value, mean``; min and
    max are rendered as strings so that every column fits one schema.  With
    ``exact_scale`` the mean of numeric columns is an order-independent average at
    that scale, otherwise Spark's ``avg``.

    Fixed-width columns and variable-width ones (strings, ...) are aggregated
    separately: min / max of strings forces Spark's interpreted sort-based aggregate,
    which would otherwise drag every other column out of generated code.  On a
    columnar source the two aggregates read disjoint columns, so nothing is read twice.
    """
    cols = list(cols) if cols is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    fixed = [c for c in cols if isinstance(types[c], _FIXED_WIDTH)]
    other = [c for c in cols if c not in set(fixed)]
    parts = [_profile_part(df, part, types, exact_scale) for part in (fixed, other) if part]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _orderable(t: T.DataType) -> bool:
    """min / max need an ordering; maps (and variants) have none."""
    if isinstance(t, T.MapType) or t.typeName() == "variant":
        return False
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def _profile_part(df: DataFrame, cols: list[str], types: dict, exact_scale: int | None) -> DataFrame:
    aggs, rows = [], []
    for i, c in enumerate(cols):
        numeric = isinstance(types[c], _NUMERIC)
        ordered = _orderable(types[c])
        col = F.col(f"`{c}`")
        aggs += [
            F.count(col).alias(f"n{i}"),
            F.sum(col.isNull().cast("long")).alias(f"z{i}"),
            (F.min(col) if ordered else F.lit(None)).alias(f"lo{i}"),
            (F.max(col) if ordered else F.lit(None)).alias(f"hi{i}"),
        ]
        if numeric:
            mean = exact_avg(col, exact_scale) if exact_scale is not None else F.avg(col.cast("double"))
            aggs.append(mean.alias(f"m{i}"))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"n{i}").alias("n"),
                F.col(f"z{i}").alias("nulls"),
                F.col(f"lo{i}").cast("string").alias("min_value"),
                F.col(f"hi{i}").cast("string").alias("max_value"),
                (F.col(f"m{i}") if numeric else F.lit(None).cast("double")).alias("mean"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _percentile_name(p: float) -> str:
    whole, _, rest = f"{p * 100:.10g}".partition(".")
    return f"p{whole:0>2}" + (f"_{rest}" if rest else "")


def approx_profile(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    rsd: float = 0.05,
    percentiles: Sequence[float] = (0.5, 0.95),
    accuracy: int = 10000,
) -> DataFrame:
    """Distinct counts and percentiles in bounded memory (HyperLogLog++ and GK sketches).

    Exact ``count(distinct)`` or ``collect_set`` on a wide key needs memory that
    grows with the data; these sketches do not.  Returns ``column,
    approx_distinct`` and one column per percentile, named after it (``p50``,
    ``p99_5``), null for non-numeric columns.
    """
    cols = list(cols) if cols is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    pnames = [_percentile_name(p) for p in percentiles]
    if len(set(pnames)) < len(pnames):
        raise ValueError("a percentile is asked for twice")
    aggs, rows = [], []
    for i, c in enumerate(cols):
        col = F.col(f"`{c}`")
        aggs.append(F.approx_count_distinct(col, rsd).alias(f"d{i}"))
        numeric = isinstance(types[c], _NUMERIC)
        fields = [F.lit(c).alias("column_name"), F.col(f"d{i}").alias("approx_distinct")]
        if numeric:
            aggs.append(F.percentile_approx(col.cast("double"), list(percentiles), accuracy).alias(f"q{i}"))
            fields += [F.col(f"q{i}")[j].alias(pn) for j, pn in enumerate(pnames)]
        else:
            fields += [F.lit(None).cast("double").alias(pn) for pn in pnames]
        rows.append(F.struct(*fields))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def ordered_top(df: DataFrame, order: Sequence[Column | str], n: int, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Global sort + limit with a total tie-break (Spark plans TakeOrderedAndProject:
    a per-partition top-n and a bounded merge, never a full sort)."""
    order = [col_of(c) for c in order]
    if tie_break is None:
        tie_break = df.columns
    return df.orderBy(*order, *[F.col(c).asc_nulls_last() for c in tie_break]).limit(n)


def topk_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[Column | str],
    k: int,
    tie_break: Sequence[str] | None = None,
    rank_col: str = "rank_in_key",
) -> DataFrame:
    """The k first rows of every key by ``order`` (ties broken by ``tie_break``).

    ``row_number() <= k`` lets Spark insert WindowGroupLimit on both sides of the
    shuffle, so a hot key costs O(k) memory per task.  It does so only up to a limit on
    ``k``; ranking by (key, salt) first bounds what reaches a key's task for any ``k``:
    ``SALTS`` times ``k`` rows.
    """
    keys = _names(keys)
    if k <= 0:
        raise ValueError("k must be positive")
    tie_break = list(tie_break) if tie_break is not None else [c for c in df.columns if c not in keys]
    by = [*[col_of(c) for c in order], *[F.col(c).asc_nulls_last() for c in tie_break]]
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > limit:
        hashable = [c for c in tie_break if _orderable(df.schema[c].dataType)]
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashable]), F.lit(SALTS)))
        within = Window.partitionBy(*keys, "__salt").orderBy(*by)
        df = salted.withColumn("__rank", F.row_number().over(within)).where(F.col("__rank") <= k).drop("__salt", "__rank")
    top = df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col(rank_col) <= k)
    return top.withColumn(rank_col, F.col(rank_col).cast("long"))
