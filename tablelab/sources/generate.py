"""Generators for skewed and uniform key sets, and derived skew on existing tables.

Amounts come from a hash of the row id, never from ``rand()``: a retried task
must produce the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.functions import hash_uniform

# Fixed values of the skewed set: 80% of rows on key 1, the rest
# spread over 50 keys starting at 2; the uniform set spreads over 100 keys from 1.
HOT_KEY = 1
HOT_SHARE = 0.8
OTHER_KEYS = 50
FIRST_OTHER_KEY = 2
UNIFORM_KEYS = 100
AMOUNT_MAX = 500.0


def _ids(spark: SparkSession, rows: int | None, ids: DataFrame | None):
    if ids is None:
        if rows is None:
            raise ValueError("give rows or ids")
        return spark.range(0, rows), F.lit(rows)
    base = ids.select(F.col(ids.columns[0]).cast("long").alias("id"))
    return base, base.agg(F.count(F.lit(1))).scalar()


def gen_skewed(
    spark: SparkSession,
    rows: int | None = 100_000,
    hot_key: int = HOT_KEY,
    hot_share: float = HOT_SHARE,
    other_keys: int = OTHER_KEYS,
    first_other_key: int = FIRST_OTHER_KEY,
    seed: int = 42,
    ids: DataFrame | None = None,
) -> DataFrame:
    """transaction_id, customer_id, amount with an exact hot share.

    Ids ``0 .. rows-1`` (or the dense ids of ``ids``, first column); the first
    ``round(rows * hot_share)`` ids carry ``hot_key``, the rest cycle over
    ``other_keys`` keys starting at ``first_other_key``.
    """
    base, n = _ids(spark, rows, ids)
    hot_rows = F.floor(n * F.lit(hot_share) + F.lit(0.5)).cast("long")
    key = F.when(F.col("id") < hot_rows, F.lit(hot_key)).otherwise(
        F.pmod(F.col("id") - hot_rows, F.lit(other_keys)) + F.lit(first_other_key)
    )
    return base.select(
        F.col("id").alias("transaction_id"),
        key.cast("long").alias("customer_id"),
        _amount(seed),
    )


def _amount(seed: int):
    """An amount in [0, AMOUNT_MAX) with cents (floor keeps it below the bound)."""
    return (F.floor(hash_uniform("id", seed=seed) * (AMOUNT_MAX * 100)) / 100).alias("amount")


def gen_uniform(
    spark: SparkSession,
    rows: int | None = 100_000,
    keys: int = UNIFORM_KEYS,
    seed: int = 43,
    ids: DataFrame | None = None,
) -> DataFrame:
    """transaction_id, customer_id = id % keys + 1, amount."""
    base, _ = _ids(spark, rows, ids)
    return base.select(
        F.col("id").alias("transaction_id"),
        (F.pmod(F.col("id"), F.lit(keys)) + 1).cast("long").alias("customer_id"),
        _amount(seed),
    )


def skew_keys(
    df: DataFrame,
    id_col: str,
    key_col: str,
    out_col: str = "customer_id",
    hot_key: int = HOT_KEY,
    hot_tenths: int = 8,
) -> DataFrame:
    """Inject skew into an existing table by a rule on its row id.

    ``out_col = hot_key`` when ``id % 10 < hot_tenths``, else ``key_col + 2``
    (so cold keys never collide with the hot one).  Both Spark and SQL can compute
    the rule, which makes skew tests checkable against an oracle.
    """
    hot = F.pmod(F.col(id_col), F.lit(10)) < F.lit(hot_tenths)
    return df.withColumn(out_col, F.when(hot, F.lit(hot_key)).otherwise(F.col(key_col) + 2).cast("long"))


def range_sum(spark: SparkSession, lo: int = 0, hi: int = 0, ids: DataFrame | None = None) -> DataFrame:
    """Sum and count of the integers ``lo .. hi-1``, or of the whole-number column ``ids``
    of a table, as one distributed aggregate.

    The sum is a ``decimal(38,0)``: for a range of 6e11 integers (a 100 TB fact
    table's row count) it is ~1.8e23, past what ``bigint`` holds."""
    base = spark.range(lo, hi) if ids is None else ids.toDF("id")
    return base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("id").cast("decimal(38,0)")).alias("total"))
