"""Connected components of a table of links, by alternating large and small stars.

Every round is two aggregations by node, joined back; links shrink towards stars, so a
component of a million rows needs a handful of rounds.  Rounds are written to the shared
folder, which cuts lineage and survives lost executors.  Nothing but counts reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.session import scratch_dir


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step on links (a, b) with a > b; the result again has a > b."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    # The least neighbour, itself included, by partial aggregation: a hub with millions of
    # links is one row per task.
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        # Larger neighbours link to the least one.
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links between whole numbers to ``(id, component)``: the least id reachable.

    Only ids with a link are returned; loops and nulls are ignored.
    """
    spark = links.sparkSession
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    while True:
        path = scratch_dir(spark, "links")
        links.write.parquet(path)
        links = spark.read.parquet(path)
        # Stars are reached when no node is both a leaf and a centre and none has two centres.
        now = links.agg(
            F.count("*").alias("n"), F.countDistinct("a").alias("leaves"),
            F.sum(F.hash("a", "b").cast("long")).alias("mark"),
        ).first()
        if now["n"] == 0:
            break
        if before == now and now["n"] == now["leaves"]:
            break
        before = now
        links = _star(_star(links, large=True), large=False)
    centres = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(centres)
