"""Registered plans: profiles, counts, ordering (build-list step 1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelab.operators import profile as P
from tablelab.operators import sketches as K
from tablelab.plans.registry import register
from tablelab.session import scratch_dir, table
from tablelab.sources import generate as G
from tablelab.sources import io as IO

# --- key_frequency -------------------------------------------------------------


@register(
    "key_frequency",
    """
with f as (select user_id, count(*) as n from events group by user_id),
     t as (select sum(n) as total, count(*) as n_keys from f)
select user_id, n, n / t.total as share, rank() over (order by n desc) as rank,
       cast(n as double) * t.n_keys / t.total as ratio_to_mean
from f, t
order by n desc, user_id
limit 100
""",
    flagship=True,
)
def key_frequency(spark, sf_dir):
    return P.key_frequency(table(spark, sf_dir, "events"), "user_id", top=100)


@register(
    "key_frequency_all",
    """
with f as (select o_custkey, count(*) as n from orders group by o_custkey),
     t as (select sum(n) as total, count(*) as n_keys from f)
select o_custkey, n, n / t.total as share, rank() over (order by n desc) as rank,
       cast(n as double) * t.n_keys / t.total as ratio_to_mean
from f, t
""",
)
def key_frequency_all(spark, sf_dir):
    return P.key_frequency(table(spark, sf_dir, "orders"), "o_custkey", top=None)


# --- global_profile ------------------------------------------------------------

_LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINEITEM_NUMERIC = set(_LINEITEM_COLS[:8])


def _profile_sql() -> str:
    parts = []
    for c in _LINEITEM_COLS:
        mean = (
            f"cast(sum(cast({c} as decimal(38,2))) as double) / cast(count({c}) as double)"
            if c in _LINEITEM_NUMERIC
            else "cast(null as double)"
        )
        parts.append(
            f"select '{c}' as column_name, count({c}) as n, count(*) - count({c}) as nulls, "
            f"cast(min({c}) as varchar) as min_value, cast(max({c}) as varchar) as max_value, "
            f"{mean} as mean from lineitem"
        )
    return "\nunion all\n".join(parts)


@register("global_profile", _profile_sql())
def global_profile(spark, sf_dir):
    return P.global_profile(table(spark, sf_dir, "lineitem"), _LINEITEM_COLS, exact_scale=2)


_APPROX_SQL = "\nunion all\n".join(
    f"select '{c}' as column_name, true as distinct_within, {'true' if c in _LINEITEM_NUMERIC else 'cast(null as boolean)'} as median_within from lineitem having count(*) > 0"
    for c in _LINEITEM_COLS
)


@register("approx_profile", _APPROX_SQL)
def approx_profile(spark, sf_dir):
    # One scan.  Each figure is held against a sketch of another kind of the same scan: distinct
    # counts against theta sketches, medians against the quantiles around the middle of a KLL sketch.
    li = table(spark, sf_dir, "lineitem").select(*_LINEITEM_COLS)
    found = P.approx_profile(li, rsd=0.02)
    other = K.profile_parts(li)
    error = F.abs(F.col("approx_distinct") - F.theta_sketch_estimate("keys"))
    at = lambda p: F.kll_sketch_get_quantile_double("quantiles", F.lit(p))
    return found.join(other, "column_name").select(
        "column_name", (error <= 0.1 * F.theta_sketch_estimate("keys") + 1).alias("distinct_within"),
        F.when(F.col("quantiles").isNotNull(), F.col("p50").between(at(0.5 - K.RANK_ERROR), at(0.5 + K.RANK_ERROR))).alias("median_within"),
    )


_STORED_SQL = "\nunion all\n".join(
    f"select '{c}' as column_name, count({c}) as n, count(*) - count({c}) as nulls, "
    + (f"cast(min({c}) as double) as least, cast(max({c}) as double) as most, " if c in _LINEITEM_NUMERIC else "cast(null as double) as least, cast(null as double) as most, ")
    + f"true as merged_is_whole, {'true' if c in _LINEITEM_NUMERIC else 'cast(null as boolean)'} as median_within from lineitem having count(*) > 0"
    for c in _LINEITEM_COLS
)


@register("stored_profile", _STORED_SQL)
def stored_profile(spark, sf_dir):
    # Two parts, as if appended one after the other, profiled apart and stored; the whole is
    # the merge of the stored rows and is held against a profile of the whole table.
    li = table(spark, sf_dir, "lineitem")
    part = F.when(F.pmod("l_orderkey", F.lit(2)) == 0, F.lit("even")).otherwise(F.lit("odd"))
    path = scratch_dir(spark, "profiles")
    K.profile_parts(li.withColumn("part", part), _LINEITEM_COLS, by="part").write.parquet(path)
    merged = K.merge_profiles(spark.read.parquet(path))
    whole = K.profile_parts(li, _LINEITEM_COLS).select("column_name", F.col("distinct").alias("d"), F.col("quantiles").alias("q"))
    both = K.figures(merged, (0.5,)).join(whole, "column_name")
    close = F.abs(F.col("approx_distinct") - F.hll_sketch_estimate("d")) <= K.DISTINCT_ERROR * F.hll_sketch_estimate("d")
    at = lambda p: F.kll_sketch_get_quantile_double("q", F.lit(p))
    number = F.col("q").isNotNull()
    return both.select(
        "column_name", "n", "nulls", F.when(number, F.col("min_value").try_cast("double")).alias("least"),
        F.when(number, F.col("max_value").try_cast("double")).alias("most"), close.alias("merged_is_whole"),
        F.when(number, F.col("p50").between(at(0.5 - 2 * K.RANK_ERROR), at(0.5 + 2 * K.RANK_ERROR))).alias("median_within"),
    )


@register(
    "frequent_keys",
    """
with s as (select case when event_id % 10 < 8 then 1 else user_id + 2 end as customer_id from events)
select customer_id, count(*) as n from s group by customer_id having count(*) >= 0.01 * (select count(*) from s)
""",
)
def frequent_keys(spark, sf_dir):
    skewed = G.skew_keys(table(spark, sf_dir, "events"), "event_id", "user_id")
    return K.frequent_keys(skewed, "customer_id", 0.01)


# --- skew_ratio ----------------------------------------------------------------


@register(
    "skew_ratio",
    """
with s as (select case when event_id % 10 < 8 then 1 else user_id + 2 end as customer_id from events)
select cast(sum(case when customer_id = 1 then 1 else 0 end) as bigint) as hits,
       count(*) as total,
       sum(case when customer_id = 1 then 1 else 0 end) / count(*) as ratio,
       sum(case when customer_id = 1 then 1 else 0 end) / count(*) > 0.7 as skewed
from s
""",
)
def skew_ratio(spark, sf_dir):
    skewed = G.skew_keys(table(spark, sf_dir, "events"), "event_id", "user_id")
    return P.skew_ratio(skewed, "customer_id", 1)


@register(
    "skew_ratio_returnflag",
    """
select cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as hits,
       count(*) as total,
       sum(case when l_returnflag = 'R' then 1 else 0 end) / count(*) as ratio,
       sum(case when l_returnflag = 'R' then 1 else 0 end) / count(*) > 0.7 as skewed
from lineitem
""",
)
def skew_ratio_returnflag(spark, sf_dir):
    return P.skew_ratio(table(spark, sf_dir, "lineitem"), "l_returnflag", "R")


# --- counts, sums, ordering ------------------------------------------------------


@register("row_count_sql", "select count(*) as cnt from orders where o_totalprice > 100000")
def row_count_sql(spark, sf_dir):
    return IO.sql_count(spark, table(spark, sf_dir, "orders"), "o_totalprice > 100000")


@register("range_sum", "select count(*) as n, cast(sum(cast(event_id as hugeint)) as decimal(38,0)) as total from events")
def range_sum(spark, sf_dir):
    # The ids of events are a range as long as the table.
    return G.range_sum(spark, ids=table(spark, sf_dir, "events").select("event_id"))


@register(
    "ordered_top",
    "select * from orders order by o_totalprice desc, o_orderkey limit 20",
)
def ordered_top(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return P.ordered_top(orders, [F.col("o_totalprice").desc()], 20, tie_break=["o_orderkey"])


@register(
    "topk_per_key",
    """
select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank_in_key
from orders
qualify rank_in_key <= 3
""",
)
def topk_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return P.topk_per_key(orders, "o_custkey", [F.col("o_totalprice").desc()], 3, tie_break=["o_orderkey"])
