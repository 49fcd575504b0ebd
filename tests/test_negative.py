"""Every rejected argument raises instead of producing a wrong result."""

import pytest

from tablelab.operators import expect as X
from tablelab.operators import profile as P
from tablelab.operators import quality as Q
from tablelab.operators import skew as S
from tablelab.operators.snapshots import Snapshots
from tablelab.session import scratch_dir
from tablelab.sources import io as IO


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "k long, s string, v double")


def test_rejected_arguments(spark, df):
    with pytest.raises(ValueError):
        P.topk_per_key(df, "k", ["v"], 0)
    with pytest.raises(ValueError):
        P.key_frequency(df, "k", top=0)
    with pytest.raises(ValueError):
        S.hot_key_join(df, df, "k", ["v"], how="full")
    with pytest.raises(ValueError):
        S.salted_join(df, df, "k", ["v"], how="right")
    with pytest.raises(ValueError):
        S.salted_agg(df, "k", [S.Agg("x", "sum", "v")], ["v"], n=0)
    with pytest.raises(ValueError):
        S.preagg_join(df, df, "k", "k", [S.Agg("x", "collect_list", "v")], ["s"])
    with pytest.raises(ValueError):
        IO.sql_count(spark, df, "v > 1", alias="cnt; drop table x")
    with pytest.raises(ValueError):
        IO.union_all([])
    with pytest.raises(ValueError):
        X.expect(df, [])
    with pytest.raises(ValueError):
        X.expect(df, [X.Check("odd", "nonsense")]).collect()
    with pytest.raises(ValueError):
        Q.parse_csv(df.selectExpr("s as value"), "a long, _corrupt_record string")
    with pytest.raises(ValueError):
        Q.as_struct("array<int>")


def test_snapshot_rejections(spark, df):
    snaps = Snapshots(spark, scratch_dir(spark, "snap-neg"))
    with pytest.raises(ValueError):
        snaps.read()  # no version yet
    with pytest.raises(ValueError):
        snaps.commit(df, mode="upsert")
    snaps.commit(df, mode="overwrite")
    with pytest.raises(ValueError):
        snaps.read(version=7)
