"""Changes of a keyed table between versions, reading only what differs.

A version is written in buckets by a hash of the key, a folder each, together with a digest
of every bucket: the number of its rows and an order-free sum of their hashes.  Digests of
buckets add up to digests of branches, and those to the version's root, so two versions are
compared from the root down: equal roots end it, equal branches leave out their buckets.
Only buckets that differ are read, and joined by key there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.operators.profile import _names
from tablelab.operators.quality import as_struct

BUCKET = "tablelab_bucket"
#: Buckets of a branch of the digest tree.
BRANCH = 64
ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def _bucketed(schema: T.StructType | str) -> T.StructType:
    return T.StructType([*as_struct(schema).fields, T.StructField(BUCKET, T.IntegerType())])


def _row_hash(df: DataFrame) -> Column:
    # Null and absent differ from every value: the text of a row names its columns.
    return F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}))


def write_version(df: DataFrame, keys: str | Sequence[str], path: str, buckets: int = 256) -> str:
    """``df`` in ``buckets`` folders below ``path``/rows and its digests below ``path``/digests.

    Choose ``buckets`` so that one is a few hundred MB, and the same for versions to be compared.
    One shuffle by bucket; digests are then read from what was written."""
    keys = _names(keys)
    if BUCKET in df.columns:
        raise ValueError(f"rename the column {BUCKET}")
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
    df.withColumn(BUCKET, bucket).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/rows")
    written = df.sparkSession.read.schema(_bucketed(df.schema)).parquet(f"{path}/rows")
    hashed = written.select(BUCKET, _row_hash(df).alias("h"))
    # Two independent sums, so that changes which cancel out in one show in the other.
    wide = F.col("h").cast("decimal(38,0)")
    second = F.xxhash64("h", F.lit(1)).cast("decimal(38,0)")
    sums = hashed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), F.sum(wide).alias("sum1"), F.sum(second).alias("sum2"))
    sums.write.parquet(f"{path}/digests")
    return path


def differing_buckets(spark: SparkSession, a: str, b: str) -> list[int]:
    """The buckets of two versions whose digests differ, found from the root down.

    At most as many numbers as there are buckets come to the driver, those that differ."""
    sides = [spark.read.parquet(f"{p}/digests").withColumn("branch", F.floor(F.col(BUCKET) / BRANCH)) for p in (a, b)]
    total = [F.sum(c).alias(c) for c in ("rows", "sum1", "sum2")]
    if sides[0].agg(*total).first() == sides[1].agg(*total).first():
        return []
    same = lambda: reduce(
        lambda x, y: x & y, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("rows", "sum1", "sum2")]
    )
    up = [s.groupBy("branch").agg(*total) for s in sides]
    branches = up[0].alias("x").join(up[1].alias("y"), "branch", "full").where(~same()).select("branch")
    left = [s.join(branches, "branch", "left_semi") for s in sides]
    found = left[0].alias("x").join(left[1].alias("y"), BUCKET, "full").where(~same()).select(BUCKET)
    return sorted(r[0] for r in found.collect())


def keyed_changes(spark: SparkSession, a: str, b: str, keys: str | Sequence[str], schema_a, schema_b=None) -> DataFrame:
    """``keys..., change, before, after`` of the rows that version ``b`` (a folder of ``write_version``) added, removed or changed
    against ``a``; ``before`` and ``after`` are the whole rows, null where there is none.

    Buckets with equal digests are not opened.  Keys must be unique: a key met twice raises.  A null key
    is a key.  Versions may differ in columns; a row whose columns differ is changed."""
    keys = _names(keys)
    differ = differing_buckets(spark, a, b)
    wanted = F.col(BUCKET).isin(differ) if differ else F.lit(False)
    read = lambda path, schema: spark.read.schema(_bucketed(schema)).parquet(f"{path}/rows").where(wanted)
    sides = []
    for path, schema, name in ((a, schema_a, "before"), (b, schema_b or schema_a, "after")):
        rows = read(path, schema)
        cols = [c for c in rows.columns if c != BUCKET]
        image = F.struct(*[F.col(f"`{c}`") for c in cols])
        named = rows.select(BUCKET, *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], image.alias(name), _row_hash(rows.drop(BUCKET)).alias(f"{name}_hash"))
        once = named.groupBy(BUCKET, *[f"k{i}" for i in range(len(keys))]).agg(
            F.first(name).alias(name), F.first(f"{name}_hash").alias(f"{name}_hash"), F.count(F.lit(1)).alias("times")
        )
        twice = F.raise_error(F.lit(f"a key is met twice in {path}")).cast("long")
        sides.append(once.withColumn(f"{name}_hash", F.when(F.col("times") == 1, F.col(f"{name}_hash")).otherwise(twice)).drop("times"))
    on = reduce(lambda x, y: x & y, [sides[0][c].eqNullSafe(sides[1][c]) for c in [BUCKET, *[f"k{i}" for i in range(len(keys))]]])
    joined = sides[0].join(sides[1], on, "full").where(~F.col("before_hash").eqNullSafe(F.col("after_hash")))
    change = F.when(F.col("before_hash").isNull(), ADDED).when(F.col("after_hash").isNull(), REMOVED).otherwise(CHANGED)
    return joined.select(
        *[F.coalesce(sides[0][f"k{i}"], sides[1][f"k{i}"]).alias(k) for i, k in enumerate(keys)], change.alias("change"), "before", "after"
    )
