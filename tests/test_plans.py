"""Plan shapes that matter at scale (read from the executed plan, not guessed)."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan(spark, key) -> str:
    df = E.queries()[key](spark, SF_SMALL)
    df.collect()  # final adaptive plan
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("\n+- == Initial Plan ==")[0]  # the top-level plan that actually ran


def test_key_frequency_reads_one_column_once(spark):
    p = plan(spark, "key_frequency")
    assert "ReadSchema: struct<user_id:bigint>" in p
    # The totals subquery reuses the main shuffle instead of scanning again.
    assert "ReusedExchange" in p or "ReusedSubquery" in p


def test_global_profile_reads_each_column_once(spark):
    p = plan(spark, "global_profile")
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    # Fixed-width and string columns are aggregated apart (generated code for the
    # first); the two scans read disjoint columns.
    assert len(scans) == 2
    schemas = [line.split("ReadSchema: struct<")[1].rstrip(">.") for line in scans]
    names = [set(f.split(":")[0] for f in s.split(",") if ":" in f) for s in schemas]
    assert not (names[0] & names[1])
    assert re.search(r"\*\(\d+\) HashAggregate", p)  # the fixed-width part runs as generated code


def test_topk_per_key_limits_before_shuffle(spark):
    p = plan(spark, "topk_per_key")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_salted_agg_reads_three_columns(spark):
    p = plan(spark, "salted_agg")
    read = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert read and all({f.split(":")[0] for f in x.split(",")} <= {"event_id", "user_id", "value"} for x in read)


@pytest.mark.parametrize("key", ["salted_join", "salted_join_hot", "hot_key_join", "preagg_join"])
def test_no_cartesian_products(spark, key):
    p = plan(spark, key)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_eventlog_filters_lines_before_parsing(spark):
    p = plan(spark, "eventlog_tasks")
    assert "Contains(value, \"SparkListenerTaskEnd\")" in p.replace("'", '"') or "Contains" in p


def test_preagg_join_aggregates_before_joining(spark):
    p = plan(spark, "preagg_join")
    join_at = p.find("Join")
    # A partial aggregate on the fact side appears below (after, in the text) the join.
    assert join_at >= 0 and "partial_count" in p[join_at:]


def test_row_count_sql_pushes_predicate(spark):
    p = plan(spark, "row_count_sql")
    assert "GreaterThan(o_totalprice,100000.0)" in p


def test_large_side_plans_without_auto_broadcast(spark):
    """With automatic broadcast off, the joins are sort-merge joins on (key, salt); only the
    list of hot keys, which the threshold bounds, is broadcast."""
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("salted_join_hot", "hot_key_join"):
            p = plan(spark, key)
            assert any("__salt" in line for line in p.splitlines() if "SortMergeJoin" in line)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
