"""Stored sketches, heavy hitters, and types inferred by the lattice."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablelab.operators import infer as N
from tablelab.operators import quality as Q
from tablelab.operators import sketches as K
from tablelab.operators import skew


def visits(spark):
    return spark.range(40_000).select(
        (F.col("id") % 2).alias("day"), (F.col("id") * 7919 % 30_011).alias("visitor"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("p"), (F.col("id") % 700).cast("string"))).alias("page"),
        ((F.col("id") * 31 % 10_007) - 5000).cast("double").alias("spent"),
    )


def test_merged_parts_are_the_profile_of_the_whole(spark, tmp_path):
    df = visits(spark)
    K.profile_parts(df, by="day").write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert stored.count() == 6
    merged = {r["column_name"]: r for r in K.figures(K.merge_profiles(stored), (0.1, 0.5)).collect()}
    whole = {r["column_name"]: r for r in K.figures(K.profile_parts(df.drop("day")), (0.1, 0.5)).collect()}
    for c, exact in (("visitor", 30_011), ("page", 560), ("spent", 10_007)):
        assert abs(merged[c]["approx_distinct"] - exact) <= K.DISTINCT_ERROR * exact
        assert [merged[c][x] for x in ("n", "nulls", "min_value", "max_value")] == [whole[c][x] for x in ("n", "nulls", "min_value", "max_value")]
    assert merged["page"]["p50"] is None and (merged["page"]["n"], merged["page"]["nulls"]) == (32_000, 8_000)
    for p, name in ((0.1, "p10"), (0.5, "p50")):
        rank = df.where(F.col("spent") <= merged["spent"][name]).count() / 40_000
        assert abs(rank - p) <= K.RANK_ERROR


def test_keys_of_two_parts(spark):
    a = K.profile_parts(spark.range(0, 30_000)).select(F.col("keys").alias("a"))
    b = K.profile_parts(spark.range(20_000, 40_000)).select(F.col("keys").alias("b"))
    row = a.join(b, F.lit(True)).select(K.shared_keys(F.col("a"), F.col("b")).alias("both"), K.new_keys(F.col("a"), F.col("b")).alias("new")).first()
    assert abs(row["both"] - 10_000) < 1_000 and abs(row["new"] - 10_000) < 1_000


def test_profiles_of_nothing(spark):
    empty = spark.createDataFrame([], "a long, m map<string,int>")
    got = {r["column_name"]: r for r in K.figures(K.merge_profiles(K.profile_parts(empty))).collect()}
    assert {c: (r["n"], r["approx_distinct"], r["p50"], r["min_value"]) for c, r in got.items()} == {"a": (0, 0, None, None), "m": (0, 0, None, None)}
    assert K.profile_parts(empty, ["m"], by="a").count() == 0


@pytest.mark.parametrize("threshold", [0.3, 0.02, 0.004])
def test_frequent_keys_are_the_hot_keys(spark, threshold):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, None, rng.randint(2, 20), rng.randint(2, 30_000)]), rng.choice("ab")) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "k long, t string").repartition(5)
    count = Counter(rows)
    want = {(*k, n) for k, n in count.items() if k[0] is not None and n >= threshold * len(rows)}
    assert {tuple(r) for r in K.frequent_keys(df, ["k", "t"], threshold).collect()} == want
    assert {tuple(r) for r in skew.hot_keys(df, ["k", "t"], threshold).collect()} == {k[:2] for k in want}
    assert K.frequent_keys(df.limit(0), "k").count() == 0
    with pytest.raises(ValueError):
        K.frequent_keys(df, "k", 0)


CSV = ["id,when,at,flag,price,note,none", "1,2024-02-29,2024-02-29 10:00,true,1,x,", "2,2024-03-01,2024-03-01T11:30:00.5,FALSE,2.5e3,7,", " ", '3,2024-03-02,,true,-.5,"a, b",', "99999999999999999999,2023-02-29,2024-01-01 00:00:00,no,n/a,,"]


def report(found):
    return {r["column_name"]: (r["type"], r["n"], r["nulls"], r["mostly"], r["misfits"], r["example"]) for r in found.collect()}


def test_types_of_untyped_csv(spark):
    lines = spark.createDataFrame([(x,) for x in CSV], "value string")
    got = report(N.types_of(N.lattice(N.csv_cells(lines, CSV[0])), share=0.7))
    assert got == {
        "id": ("double", 4, 0, "bigint", 1, "99999999999999999999"), "when": ("string", 4, 0, "date", 1, "2023-02-29"),
        "at": ("timestamp_ntz", 3, 1, None, None, None), "flag": ("string", 4, 0, "boolean", 1, "no"),
        "price": ("string", 4, 0, "double", 1, "n/a"), "note": ("string", 3, 1, None, None, None), "none": ("void", 0, 4, None, None, None),
    }


def test_parts_merge_to_the_whole_and_feed_the_drift_report(spark):
    lines = [spark.createDataFrame([(x,) for x in CSV[:1] + part], "value string") for part in (CSV[1:3], CSV[3:])]
    parts = [N.lattice(N.csv_cells(x, CSV[0])) for x in lines]
    whole = N.lattice(N.csv_cells(lines[0].union(lines[1]), CSV[0]))
    assert report(N.types_of(N.merge(*parts))) == report(N.types_of(whole))
    schema = N.inferred_schema(N.types_of(parts[0]), CSV[0].split(","))
    assert [f.dataType.simpleString() for f in schema] == ["bigint", "date", "timestamp_ntz", "boolean", "double", "string", "string"]
    drift = {r["column_name"] or r["observed_name"]: r["status"] for r in Q.schema_drift(spark, schema, "id bigint, `when` string, gone int").collect()}
    assert drift["id"] == "same" and drift["when"] == "type_changed" and drift["gone"] == "missing" and drift["price"] == "extra"


def test_types_of_json_objects(spark):
    lines = ['{"a":1,"b":{"c":"2024-01-01","d":[1]},"e":null}', '{"a":2.5,"b":{"c":"x"},"f":true}', '{"a":"7","b":[1]}', "no json", "[1]", None, "{}"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = report(N.types_of(N.lattice(N.json_cells(df, depth=2))))
    assert {c: v[:3] for c, v in got.items()} == {
        "a": ("string", 3, 0), "b": ("variant", 3, 0), "b.c": ("string", 2, 0), "b.d": ("array", 1, 0), "e": ("void", 0, 1), "f": ("boolean", 1, 0),
    }
    assert N.types_of(N.lattice(N.json_cells(df.limit(0)))).count() == 0
