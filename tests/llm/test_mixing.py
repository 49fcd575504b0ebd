import random

from pyspark.sql import functions as F

from tablelab.llm import mixing
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, mix string, _mix_size int, _LEVEL int"
HELPERS = ["_mix_size", "_mix_source", "_mix_null", "_mix_target", "mix", "copy", "source_size", "size"]


def test_targets_are_those_of_repeated_resharing(spark):
    rng = random.Random(3)
    for trial in range(4):
        sizes = {f"s{k}": rng.choice([0, 1, 5, 40, 900, 20_000]) for k in range(rng.randint(1, 12))}
        if trial % 2:
            sizes[None] = 17
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = brute.targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in want)
        assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6 * max(1, sum(sizes.values()))


def test_mix_against_brute_force_and_edges(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 60))), rng.choice(["a", "b", "c", "", None])) for i in range(300)]
    rows += [(1000, None, "a"), (None, "x y z", "b"), (1001, "", None), (1002, "q " * 5000, "c"), (1002, "q " * 5000, "c")]
    df = spark.createDataFrame([(*r, "m", 1, 2) for r in rows], SCHEMA)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    target = brute.targets(sizes)
    got = mixing.plan_mix(df).collect()
    assert len(got) == len(rows)
    for r in got:
        m, rate = r["_mix"], target[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        copies = int(rate + 1e-12) + (brute.draw(r["doc_id"], mixing.SEED) < rate - int(rate + 1e-12))
        assert m["size"] == len(brute.words(r["text"])) and m["copies"] == copies <= 3
        assert m["source_size"] == sizes[r["source"]]
    mixed = mixing.mix(df)
    assert mixed.count() == sum(r["_mix"]["copies"] for r in got)
    assert mixed.columns == [*df.columns, "copy"] and {r["mix"] for r in mixed.collect()} == {"m"}
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))


def test_sources_come_near_their_targets(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"),
    )
    rows = mixing.plan_mix(df).groupBy("source").agg(F.sum(F.col("mix.copies") * F.col("mix.size")).alias("n"), F.first("mix.target").alias("t"))
    assert all(abs(r["n"] - r["t"]) < 0.03 * r["t"] for r in rows.collect())


def test_plan_is_native_and_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    planned = mixing.plan_mix(df)
    assert planned.count() == 0 and mixing.mix(df).count() == 0
    plan = planned._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_every_helper_name_may_be_a_column(spark):
    rows = [(k, "w " * (k % 5), "ab"[k % 2], f"v{k}") for k in range(20)]
    want = sorted(map(tuple, mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, extra string")).collect()))
    for name in HELPERS:
        df = spark.createDataFrame(rows, f"doc_id long, text string, source string, {name} string")
        mixed = mixing.mix(df)
        assert mixed.columns[:4] == df.columns and sorted(map(tuple, mixed.collect())) == want
