"""Registered plans: skew-aware aggregation and joins, layout reports (step 6).

Skew is injected into ``events`` by rule: ``customer_id`` = 1 for 80% of rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelab.operators import skew as S
from tablelab.plans.registry import register
from tablelab.session import table
from tablelab.sources.derived import skewed_events

_SKEWED = "(select *, case when event_id % 10 < 8 then 1 else user_id + 2 end as customer_id from events)"

def _aggs():
    return [
        S.Agg("n", "count"),
        S.Agg("total", "sum", F.col("value").cast("decimal(18,2)")),
        S.Agg("lo", "min", "value"),
        S.Agg("hi", "max", "value"),
    ]


@register(
    "salted_agg",
    f"""
select customer_id, count(*) as n, cast(sum(cast(value as decimal(18,2))) as double) as total,
       min(value) as lo, max(value) as hi
from {_SKEWED} s group by customer_id
""",
)
def salted_agg(spark, sf_dir):
    out = S.salted_agg(skewed_events(table(spark, sf_dir, "events")), "customer_id", _aggs(), ["event_id"], n=16)
    return out.withColumn("total", F.col("total").cast("double"))


_JOINED = f"""
select s.event_id, s.customer_id, c.c_name, c.c_nationkey
from {_SKEWED} s {{how}} join customer c on c.c_custkey = s.customer_id
"""


def _sides(spark, sf_dir):
    events = skewed_events(table(spark, sf_dir, "events")).select("event_id", "customer_id")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), "c_name", "c_nationkey")
    return events, customers


@register("salted_join", _JOINED.format(how=""))
def salted_join(spark, sf_dir):
    # The hot keys are known beforehand: the rule that skews the table has one.
    events, customers = _sides(spark, sf_dir)
    known = spark.createDataFrame([(1,)], "customer_id long")
    return S.salted_join(events, customers, "customer_id", ["event_id"], n=8, hot_keys=known, hot_bound=1)


@register("salted_join_hot", _JOINED.format(how="left"))
def salted_join_hot(spark, sf_dir):
    events, customers = _sides(spark, sf_dir)
    hot = S.hot_keys(events, "customer_id", 0.05)
    return S.salted_join(events, customers, "customer_id", ["event_id"], n=16, how="left", hot_keys=hot)


@register("hot_key_join", _JOINED.format(how="left"))
def hot_key_join(spark, sf_dir):
    events, customers = _sides(spark, sf_dir)
    return S.hot_key_join(events, customers, "customer_id", ["event_id"], threshold=0.05, how="left")


@register(
    "preagg_join",
    """
select n_name, count(*) as orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue,
       max(o_totalprice) as max_price
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
group by n_name
""",
)
def preagg_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    dim = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    aggs = [
        S.Agg("orders", "count"),
        S.Agg("revenue", "sum", F.col("o_totalprice").cast("decimal(18,2)")),
        S.Agg("max_price", "max", "o_totalprice"),
    ]
    out = S.preagg_join(orders, dim, "o_custkey", "c_custkey", aggs, ["n_name"])
    return out.withColumn("revenue", F.col("revenue").cast("double"))


def _balance_summary(balance):
    """What SQL can check: all rows are in some partition, one of them is the largest."""
    return balance.agg(
        F.sum("rows").alias("rows"), F.max("share_of_max").alias("top_share"),
        (F.count(F.lit(1)) == F.countDistinct("partition")).alias("one_row_each"), (F.min("bytes") > 0).alias("all_have_bytes"),
    )


_BALANCE_SQL = "select count(*) as rows, cast(1.0 as double) as top_share, true as one_row_each, true as all_have_bytes from lineitem"


@register("partition_balance", _BALANCE_SQL)
def partition_balance(spark, sf_dir):
    return _balance_summary(S.partition_balance(table(spark, sf_dir, "lineitem").repartition("l_orderkey")))


@register("partition_balance_range", _BALANCE_SQL)
def partition_balance_range(spark, sf_dir):
    return _balance_summary(S.partition_balance(S.balance_by_range(table(spark, sf_dir, "lineitem"), "l_orderkey")))


@register(
    "file_layout",
    "select 'lineitem.parquet' as file_name, count(*) as rows, true as has_size, true as small_file, false as fat_file from lineitem",
)
def file_layout(spark, sf_dir):
    layout = S.file_layout(table(spark, sf_dir, "lineitem"))
    return layout.select("file_name", "rows", (F.col("size_bytes") > 0).alias("has_size"), "small_file", "fat_file")
