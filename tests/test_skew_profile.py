"""Generators, profiles, skew operators and expectations: invariants, negatives, plans."""

import pytest
from pyspark.sql import functions as F

from tablelab.operators import expect as X
from tablelab.operators import profile as P
from tablelab.operators import skew as S
from tablelab.sources import generate as G
from tablelab.sources import io as IO


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, x) for x in t))


@pytest.fixture(scope="module")
def skewed(spark):
    return G.gen_skewed(spark, 100_000).cache()


def test_gen_skewed_layout(spark, skewed):
    assert skewed.count() == 100_000
    assert skewed.select("transaction_id").distinct().count() == 100_000
    r = P.skew_ratio(skewed, "customer_id", 1).first()
    assert (r["hits"], r["total"], r["ratio"], r["skewed"]) == (80_000, 100_000, 0.8, True)
    cold = skewed.where("customer_id <> 1").groupBy("customer_id").count()
    assert cold.count() == 50 and {r["count"] for r in cold.collect()} == {400}
    assert skewed.agg(F.min("amount"), F.max("amount")).first()[1] < 500


def test_gen_is_deterministic(spark):
    a = G.gen_skewed(spark, 1000).collect()
    b = G.gen_skewed(spark, 1000).collect()
    assert sorted(a) == sorted(b)


def test_gen_uniform_layout(spark):
    u = G.gen_uniform(spark, 100_000)
    counts = {r["count"] for r in u.groupBy("customer_id").count().collect()}
    assert counts == {1000} and u.select("customer_id").distinct().count() == 100


def test_local_rows_profile_and_sql(spark):
    """A small local table: sizes of blocks, powers of two, some unknown."""
    rows = [(f"b{k:02d}", 2**k, None if k % 5 == 0 else 2.0**-k) for k in range(1, 21)]
    df = spark.createDataFrame(rows, "`block.name` string, size long, ratio double")
    prof = {r["column_name"]: r for r in P.global_profile(df).collect()}
    assert (prof["size"]["n"], prof["size"]["min_value"], prof["size"]["max_value"]) == (20, "2", str(2**20))
    assert prof["size"]["mean"] == sum(r[1] for r in rows) / 20
    assert (prof["ratio"]["nulls"], prof["block.name"]["max_value"]) == (4, "b20")
    assert IO.sql_count(spark, df, "size >= 1024").first()["cnt"] == 11
    assert G.range_sum(spark, 5, 50).first()["total"] == sum(range(5, 50))
    assert G.range_sum(spark, ids=df.select("size")).first()["total"] == 2**21 - 2


@pytest.mark.parametrize("n", [1, 3, 16])
def test_salted_agg_equals_plain(spark, skewed, n):
    aggs = [
        S.Agg("n", "count"),
        S.Agg("total", "sum", F.col("amount").cast("decimal(18,2)")),
        S.Agg("lo", "min", "amount"),
        S.Agg("hi", "max", "amount"),
        S.Agg("mean", "avg", F.col("amount").cast("decimal(18,2)")),
    ]
    salted = S.salted_agg(skewed, "customer_id", aggs, ["transaction_id"], n=n)
    plain = skewed.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("total"),
        F.min("amount").alias("lo"),
        F.max("amount").alias("hi"),
        (F.sum(F.col("amount").cast("decimal(18,2)")).cast("double") / F.count("amount")).alias("mean"),
    )
    cols = ["customer_id", "n", "total", "lo", "hi", "mean"]
    assert sorted_rows(salted, *cols) == sorted_rows(plain, *cols)


def test_salted_agg_rejects_non_decomposable(skewed):
    with pytest.raises(ValueError):
        S.salted_agg(skewed, "customer_id", [S.Agg("m", "median", "amount")], ["transaction_id"])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(spark, skewed, how):
    small = spark.createDataFrame([(k, f"c{k}") for k in range(1, 40)] + [(1, "dup")], "customer_id long, name string")
    big = skewed.union(spark.createDataFrame([(999_999, None, 1.0)], skewed.schema))  # a null key
    cols = big.columns + (["name"] if how in ("inner", "left") else [])
    plain = big.join(small, "customer_id", how)
    for hot in (None, spark.createDataFrame([(1,)], "customer_id long")):
        salted = S.salted_join(big, small, "customer_id", ["transaction_id"], n=8, how=how, hot_keys=hot)
        assert sorted_rows(salted, *cols) == sorted_rows(plain, *cols)
        assert "CartesianProduct" not in plan_of(salted) and "NestedLoop" not in plan_of(salted)


def test_salted_join_rejects_outer(skewed):
    with pytest.raises(ValueError):
        S.salted_join(skewed, skewed, "customer_id", ["transaction_id"], how="full")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_join_equals_plain(spark, skewed, how):
    small = spark.createDataFrame([(k, f"c{k}") for k in range(1, 60, 2)], "customer_id long, name string")
    big = skewed.union(spark.createDataFrame([(999_999, None, 1.0)], skewed.schema))
    out = S.hot_key_join(big, small, "customer_id", ["transaction_id"], threshold=0.05, how=how)
    cols = ["transaction_id", "customer_id", "amount", "name"]
    assert sorted_rows(out, *cols) == sorted_rows(big.join(small, "customer_id", how), *cols)
    assert "BroadcastHashJoin" in plan_of(out)


def test_hot_key_join_with_many_rows_on_both_sides(spark, skewed):
    small = spark.range(50).select(F.lit(1).cast("long").alias("customer_id"), F.col("id").alias("v"))
    some = skewed.where("transaction_id < 1000")
    out = S.hot_key_join(some, small, "customer_id", ["transaction_id"], threshold=0.5)
    assert out.count() == some.where("customer_id = 1").count() * 50


def test_hot_key_join_runs_nothing_before_its_result_is_used(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-join", "planning only")
    try:
        S.hot_key_join(skewed, skewed.select("customer_id").distinct(), "customer_id", ["transaction_id"], threshold=0.05)
        assert list(tracker.getJobIdsForGroup("lazy-join")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_keys_are_bounded_by_the_threshold_only(spark, skewed):
    assert [tuple(r) for r in S.hot_keys(skewed, "customer_id", 0.05).collect()] == [(1,)]
    even = spark.range(4000).select((F.col("id") % 2000).alias("k"), "id")
    assert S.hot_keys(even, "k", 1 / 2000).count() == 2000
    small = spark.range(2000).withColumnRenamed("id", "k")
    joined = S.salted_join(even, small, "k", ["id"], n=4, hot_keys=S.hot_keys(even, "k", 1 / 2000))
    assert joined.count() == 4000


def test_salt_spreads_rows_that_are_alike_but_for_their_id(spark):
    df = spark.range(10_000).select(F.lit(1).alias("k"), F.lit("same").alias("v"), "id", F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    counts = [r["count"] for r in df.groupBy(S.row_salt(16, ["id"])).count().collect()]
    assert len(counts) == 16 and max(counts) < 1.3 * min(counts)
    out = S.salted_agg(df, "k", [S.Agg("n", "count")], ["id"], n=16)
    assert out.first()["n"] == 10_000
    with pytest.raises(ValueError):
        S.row_salt(16, [])


def test_topk_beyond_the_engine_limit_is_exact_and_bounded(spark, skewed):
    k = 3000
    top = P.topk_per_key(skewed, "customer_id", [F.col("amount").desc()], k)
    assert "__salt" in plan_of(top)
    assert top.where("customer_id = 1").count() == k and top.where("customer_id <> 1").count() == 20_000
    want = skewed.where("customer_id = 1").orderBy(F.col("amount").desc(), "transaction_id").limit(k)
    assert sorted_rows(top.where("customer_id = 1"), "transaction_id") == sorted_rows(want, "transaction_id")
    assert top.columns == [*skewed.columns, "rank_in_key"]


def test_percentile_names_are_distinct(spark, skewed):
    out = P.approx_profile(skewed, ["amount"], percentiles=[0.05, 0.5, 0.995, 0.999])
    assert out.columns == ["column_name", "approx_distinct", "p05", "p50", "p99_5", "p99_9"]
    with pytest.raises(ValueError):
        P.approx_profile(skewed, ["amount"], percentiles=[0.5, 0.5])


def test_key_frequency_returns_all_keys_unless_asked(spark):
    assert P.key_frequency(spark.range(500), "id").count() == 500


def test_preagg_join_equals_join_then_aggregate(spark, skewed):
    dim = spark.createDataFrame([(k, f"g{k % 3}") for k in range(1, 52)], "customer_id long, grp string")
    aggs = [S.Agg("n", "count"), S.Agg("total", "sum", F.col("amount").cast("decimal(18,2)"))]
    out = S.preagg_join(skewed, dim, "customer_id", "customer_id", aggs, ["grp"])
    ref = skewed.join(dim, "customer_id").groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("total")
    )
    assert sorted_rows(out, "grp", "n", "total") == sorted_rows(ref, "grp", "n", "total")


def test_key_frequency_ranks(spark, skewed):
    all_keys = P.key_frequency(skewed, "customer_id", top=None)
    rows = {r["customer_id"]: r for r in all_keys.collect()}
    assert rows[1]["rank"] == 1 and rows[1]["share"] == 0.8
    assert {r["rank"] for k, r in rows.items() if k != 1} == {2}  # 50 ties share rank 2
    assert rows[1]["ratio_to_mean"] == pytest.approx(80_000 / (100_000 / 51))
    top = P.key_frequency(skewed, "customer_id", top=3).collect()
    assert [r["customer_id"] for r in top] == [1, 2, 3] and [r["rank"] for r in top] == [1, 2, 2]


def test_topk_and_profile_plans(spark, skewed):
    top = P.topk_per_key(skewed, "customer_id", [F.col("amount").desc()], 2)
    assert top.count() == 51 * 2
    assert "WindowGroupLimit" in plan_of(top)
    prof = {r["column_name"]: r for r in P.global_profile(skewed).collect()}
    assert prof["customer_id"]["min_value"] == "1" and prof["transaction_id"]["n"] == 100_000


def test_approx_profile_within_error(spark, skewed):
    out = {r["column_name"]: r for r in P.approx_profile(skewed, ["transaction_id", "customer_id"], rsd=0.05).collect()}
    assert abs(out["transaction_id"]["approx_distinct"] - 100_000) / 100_000 < 0.15
    assert out["customer_id"]["p50"] == 1.0


def test_partition_balance_totals(spark, skewed):
    bal = S.partition_balance(skewed.repartition(7, "customer_id"))
    assert bal.agg(F.sum("rows")).first()[0] == 100_000
    assert bal.agg(F.max("share_of_max")).first()[0] == 1.0
    ranged = S.partition_balance(S.balance_by_range(skewed, "transaction_id", 4))
    sizes = [r["rows"] for r in ranged.collect()]
    # Range bounds come from a sample: even, not exact.
    assert sum(sizes) == 100_000 and len(sizes) == 4 and all(20_000 < s < 30_000 for s in sizes)


def test_expectations_results_and_assert(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 50), (2, "c", 7)], "id long, name string, v int")
    checks = [
        X.unique("id"),
        X.not_null("name"),
        X.in_range("v", 0, 10),
        X.row_count(lo=3, hi=3),
        X.has_columns(["id", "v"]),
        X.lacks_columns(["region"]),
    ]
    res = {r["label"]: r for r in X.expect(df, checks).collect()}
    assert res["id unique"]["passed"] is False and res["id unique"]["violations"] == 1
    assert res["name not null"]["violations"] == 1
    assert res["v in [0, 10]"]["violations"] == 1
    assert res["row count in [3, 3]"]["passed"] is True
    assert res["has id, v"]["passed"] and res["lacks region"]["passed"]
    s = X.summarize(X.expect(df, checks)).first()
    assert (s["passed"], s["failed"], s["total"]) == (3, 3, 6)
    with pytest.raises(X.ExpectationError) as e:
        X.assert_all(X.expect(df, checks))
    assert "id unique" in str(e.value) and "name not null" in str(e.value)
    X.assert_all(X.expect(df, [X.has_columns(["id"])]))  # passes silently


def test_profile_handles_nested_and_map_columns(spark):
    df = spark.createDataFrame([(1, [1, 2], {"a": "b"}), (None, [3], None)], "k long, arr array<int>, m map<string,string>")
    out = {r["column_name"]: r for r in P.global_profile(df).collect()}
    assert out["k"]["nulls"] == 1 and out["arr"]["max_value"] == "[3]"
    assert out["m"]["n"] == 1 and out["m"]["min_value"] is None


def test_roundtrip_keeps_empty_and_null_partition_values(spark):
    from tablelab.session import scratch_dir

    df = spark.createDataFrame([(1, ""), (2, None), (3, "x/y")], "id long, `p.q` string")
    back = IO.roundtrip_parquet(df, scratch_dir(spark, "rt"), partition_by=["p.q"])
    assert sorted(map(tuple, back.collect())) == [(1, ""), (2, None), (3, "x/y")] and back.columns == df.columns


def test_save_and_drop_table(spark):
    from tablelab.session import scratch_dir

    df = spark.range(7)
    assert IO.save_table(df, "nums", "tl_test", location=scratch_dir(spark, "db")) == 7
    assert IO.save_table(df, "nums", "tl_test", mode="append") == 7
    assert spark.table("tl_test.nums").count() == 14
    IO.drop_table(spark, "nums", "tl_test", with_database=True)
    assert not spark.catalog.databaseExists("tl_test")


def test_roundtrip_keeps_partition_types(spark):
    from tablelab.session import scratch_dir

    df = spark.createDataFrame([(1, "01"), (2, "10")], "id long, code string")
    back = IO.roundtrip_parquet(df, scratch_dir(spark, "rt"), partition_by=["code"])
    assert back.schema == df.schema and sorted(back.collect()) == sorted(df.collect())


def test_multi_column_keys(spark, skewed):
    two = skewed.withColumn("region", (F.col("transaction_id") % 2).cast("long"))
    freq = {(r["customer_id"], r["region"]): r for r in P.key_frequency(two, ["customer_id", "region"], top=None).collect()}
    assert freq[(1, 0)]["n"] == 40_000 and freq[(1, 0)]["rank"] == 1 and freq[(1, 1)]["rank"] == 1
    dim = spark.createDataFrame([(k, r, f"c{k}-{r}") for k in range(1, 30) for r in (0, 1)],
                                "customer_id long, region long, name string")
    cols = ["transaction_id", "customer_id", "region", "name"]
    for how in ("inner", "left"):
        out = S.hot_key_join(two, dim, ["customer_id", "region"], ["transaction_id"], threshold=0.1, how=how)
        assert sorted_rows(out, *cols) == sorted_rows(two.join(dim, ["customer_id", "region"], how), *cols)


def test_a_long_list_of_hot_keys_salts_every_key(spark, monkeypatch):
    big = spark.range(3000).selectExpr("id", "id % 300 as k")
    small = spark.range(300).selectExpr("id as k", "id * 2 as v")
    hot = spark.range(200).selectExpr("id as k")
    want = sorted(map(tuple, big.join(small, "k").select("id", "k", "v").collect()))
    for most in (1000, 50):
        monkeypatch.setattr(S, "MAX_HOT", most)
        joined = S.salted_join(big, small, "k", ["id"], n=4, hot_keys=hot)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert ("__hot" in plan) == (most == 1000)
        assert sorted(map(tuple, joined.select("id", "k", "v").collect())) == want


def test_concurrency_against_every_millisecond(spark):
    import datetime as dt
    import random

    from tablelab.operators import eventlog as EL

    rng = random.Random(3)
    zero = dt.datetime(2024, 1, 1)
    spans = [("x", s, s + rng.choice([0, 1, 5, 40, 260])) for s in (rng.randrange(900) for _ in range(60))] + [("y", 10, 990), ("y", 995, 995), ("y", 1500, 1510)]
    rows = [("a", x, zero + dt.timedelta(milliseconds=s), zero + dt.timedelta(milliseconds=e)) for x, s, e in spans]
    rows += [("a", "x", zero, None), ("a", "x", zero + dt.timedelta(seconds=9), zero)]
    df = spark.createDataFrame(rows, "app string, executor_id string, launch_time timestamp_ntz, finish_time timestamp_ntz")
    got = {(r["executor_id"], round((r["bucket_start"] - zero).total_seconds() * 1000)): r for r in EL.concurrency(df, 100).collect()}
    assert len(got) == EL.concurrency(df, 100).count()
    for x in "xy":
        running = [sum(a <= t < b for e, a, b in spans if e == x) for t in range(1600)]
        for start in range(0, 1600, 100):
            some = any(e == x and a < start + 100 and b >= start for e, a, b in spans)
            assert ((x, start) in got) == some
            if some:
                r = got[x, start]
                assert r["busy_ms"] == sum(running[start : start + 100]) and r["peak"] == max(running[start : start + 100] + [r["open_at_start"]])
                assert r["started"] == sum(e == x and start <= a < start + 100 for e, a, b in spans)
                assert r["slots"] == max(running) and r["busy_share"] <= 1
    assert EL.concurrency(df.limit(0)).count() == 0
