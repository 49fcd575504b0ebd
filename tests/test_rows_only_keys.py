"""Exact checks of operators whose registered queries show flags only (sf0.01)."""

import duckdb

from tablelab.operators import profile as P
from tablelab.operators import skew as S
from tests.conftest import SF_ORACLE


def duck_scalar(sql: str):
    return duckdb.sql(sql.replace("{sf}", SF_ORACLE)).fetchall()[0][0]


def test_partitions_hold_all_rows(spark):
    li = spark.read.parquet(f"{SF_ORACLE}/lineitem.parquet")
    for df in (li.repartition(9, "l_orderkey"), S.balance_by_range(li, "l_orderkey", 9)):
        rows = S.partition_balance(df).collect()
        assert sum(r["rows"] for r in rows) == duck_scalar("select count(*) from '{sf}/lineitem.parquet'")
        assert max(r["share_of_max"] for r in rows) == 1.0 and all(r["bytes"] > 0 for r in rows)


def test_sketches_against_exact(spark):
    cols = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    rows = {r["column_name"]: r for r in P.approx_profile(spark.read.parquet(f"{SF_ORACLE}/lineitem.parquet"), cols).collect()}
    for c in cols:
        exact = duck_scalar(f"select count(distinct {c}) from '{{sf}}/lineitem.parquet'")
        assert abs(rows[c]["approx_distinct"] - exact) <= 0.15 * exact
    median = duck_scalar("select quantile_disc(l_quantity, 0.5) from '{sf}/lineitem.parquet'")
    assert abs(rows["l_quantity"]["p50"] - median) <= 1.0
