"""Registered plans: versioned snapshot sets (build-list step 5).

A two-version table on ``orders``: version 0 is the
even order keys without ``o_orderpriority`` (overwrite), version 1 appends the odd
keys with it (schema merged).  Each plan seeds a fresh folder in shared scratch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelab.operators import keyed as KD
from tablelab.operators.snapshots import Snapshots
from tablelab.plans.registry import register
from tablelab.session import scratch_dir, session_fixture, table

V0_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def seed(spark, sf_dir, snaps: Snapshots | None = None) -> Snapshots:
    snaps = snaps or Snapshots(spark, scratch_dir(spark, "snapshots"))
    orders = table(spark, sf_dir, "orders")
    even = F.pmod(F.col("o_orderkey"), F.lit(2)) == 0
    snaps.commit(orders.where(even).select(*V0_COLS), mode="overwrite")
    snaps.commit(orders.where(~even), mode="append", merge_schema=True)
    return snaps


def seeded(spark, sf_dir) -> Snapshots:
    """A seeded table shared by the plans that only read it (one per application)."""
    return session_fixture(spark, f"snapshots:{sf_dir}", lambda: seed(spark, sf_dir))


@register(
    "snap_latest",
    """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       case when o_orderkey % 2 = 0 then null else o_orderpriority end as o_orderpriority
from orders
""",
)
def snap_latest(spark, sf_dir):
    return seeded(spark, sf_dir).read()


@register(
    "snap_as_of",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate from orders where o_orderkey % 2 = 0",
)
def snap_as_of(spark, sf_dir):
    return seeded(spark, sf_dir).read(version=0)


_HISTORY_SQL = """
select cast({gen} as bigint) as generation, cast(0 as bigint) as version, 'overwrite' as operation,
       cast(count_if(o_orderkey % 2 = 0) as bigint) as num_rows, cast(5 as bigint) as num_columns from orders
union all
select {gen}, 1, 'append', cast(count_if(o_orderkey % 2 = 1) as bigint), 6 from orders
"""


@register("snap_history", _HISTORY_SQL.format(gen=0))
def snap_history(spark, sf_dir):
    return seeded(spark, sf_dir).history().drop("committed_at")


@register("snap_reset", _HISTORY_SQL.format(gen=1))
def snap_reset(spark, sf_dir):
    # Seeding twice, with a reset in between, ends at exactly two versions.
    snaps = seed(spark, sf_dir)
    snaps.reset()
    return seed(spark, sf_dir, snaps).history().drop("committed_at")


@register(
    "snap_schema_diff",
    "select 'o_orderpriority' as column_name, 'added' as change, cast(null as varchar) as from_type, 'string' as to_type",
)
def snap_schema_diff(spark, sf_dir):
    return seeded(spark, sf_dir).schema_diff(0, 1)


@register(
    "snap_changes",
    """
select 'added' as change, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderkey % 2 = 1
""",
)
def snap_changes(spark, sf_dir):
    return seeded(spark, sf_dir).changes(0, 1)


@register(
    "snap_changes_overwrite",
    """
select 'added' as change, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority from orders where o_orderstatus = 'F' and o_orderkey % 2 = 0
union all
select 'removed', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       case when o_orderkey % 2 = 0 then null else o_orderpriority end
from orders where o_orderstatus <> 'F' or o_orderkey % 2 = 0
""",
)
def snap_changes_overwrite(spark, sf_dir):
    # After an overwrite the versions share no folder: compared with EXCEPT ALL.
    # Even-key 'F' rows differ (o_orderpriority was null in version 1), so they are
    # both removed (old form) and added (new form).
    snaps = seed(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    snaps.commit(orders.where(F.col("o_orderstatus") == "F"), mode="overwrite")
    return snaps.changes(1, 2)


_NEXT = """(select case when o_orderkey % 1000 = 31 then o_orderkey + 1000000000 else o_orderkey end as o_orderkey, o_custkey, o_orderstatus,
    case when o_orderkey % 1000 = 7 then o_totalprice + 1 else o_totalprice end as o_totalprice from orders where o_orderkey % 1000 <> 13)"""


@register(
    "keyed_changes",
    f"""
select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
       case when a.o_orderkey is null then 'added' when b.o_orderkey is null then 'removed' else 'changed' end as change,
       a.o_totalprice as price_before, b.o_totalprice as price_after
from orders a full join {_NEXT} b on a.o_orderkey = b.o_orderkey
where a.o_orderkey is null or b.o_orderkey is null or a.o_totalprice <> b.o_totalprice
""",
)
def keyed_changes(spark, sf_dir):
    # The next version drops, changes and renumbers one order in a thousand each.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    turn = F.pmod("o_orderkey", F.lit(1000))
    later = orders.where(turn != 13).withColumn("o_totalprice", F.when(turn == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    later = later.withColumn("o_orderkey", F.when(turn == 31, F.col("o_orderkey") + 1000000000).otherwise(F.col("o_orderkey")))
    buckets = orders.count() // 2000 + 1
    a, b = (KD.write_version(df, "o_orderkey", scratch_dir(spark, "keyed"), buckets) for df in (orders, later))
    found = KD.keyed_changes(spark, a, b, "o_orderkey", orders.schema)
    return found.select("o_orderkey", "change", F.col("before.o_totalprice").alias("price_before"), F.col("after.o_totalprice").alias("price_after"))
