"""Snapshots, streams against their batch form, event logs, Python batches."""

import datetime
import glob
import json
import os
import tempfile

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tablelab.functions import exact_sum
from tablelab.operators import eventlog as EL
from tablelab.operators import udf as U
from tablelab.operators.snapshots import SchemaMismatch, Snapshots
from tablelab.plans import stream_plans
from tablelab.session import scratch_dir, session_fixture
from tablelab.sources import derived as D
from tablelab.sources import eventlog as ES
from tablelab.streaming import runner
from tablelab.streaming import windows as W
from tests.conftest import SF_SMALL

# Shelves of a store: what is on them, later also since when.
SHELF = "shelf string, slot int, item string, weight float"
FIRST = [(f"a{k % 3}", k, f"thing{k * k}", k / 4) for k in range(12)]
LATER = [(f"b{k}", k, None, None, f"2024-0{k + 1}-01") for k in range(4)]


def fresh_table(spark, name):
    return Snapshots(spark, scratch_dir(spark, name))


def seed(spark, snaps):
    snaps.commit(spark.createDataFrame(FIRST, SHELF), mode="overwrite")
    snaps.commit(spark.createDataFrame(LATER, SHELF + ", since string"), mode="append", merge_schema=True)


def test_versions_keep_their_own_schema(spark):
    snaps = fresh_table(spark, "snap-test")
    seed(spark, snaps)
    assert [r["num_rows"] for r in snaps.history().orderBy("version").collect()] == [12, 4]
    assert snaps.read().columns == ["shelf", "slot", "item", "weight", "since"]
    assert snaps.read().where("since is null").count() == 12
    assert snaps.read(version=0).columns == ["shelf", "slot", "item", "weight"] and snaps.read(version=0).count() == 12
    assert [(r["column_name"], r["change"]) for r in snaps.schema_diff(0, 1).collect()] == [("since", "added")]
    assert sorted(r["shelf"] for r in snaps.changes(0, 1).collect()) == ["b0", "b1", "b2", "b3"]


def test_reset_starts_a_new_history_and_tells_what_is_left_over(spark):
    snaps = fresh_table(spark, "snap-reset")
    seed(spark, snaps)
    assert snaps.unreferenced().count() == 0
    snaps.reset()
    seed(spark, snaps)
    h = snaps.history().orderBy("version").collect()
    assert [(r["version"], r["operation"]) for r in h] == [(0, "overwrite"), (1, "append")]
    assert snaps.read().count() == 16  # nothing of the first seeding
    left = snaps.unreferenced().collect()
    assert sorted(r["num_rows"] for r in left) == [4, 12] and len({r["folder"] for r in left}) == 2


def test_overwrite_adds_a_version(spark):
    snaps = fresh_table(spark, "snap-ow")
    seed(spark, snaps)
    one = spark.createDataFrame([("a0", 0, "thing0", 0.0)], SHELF)
    assert snaps.commit(one.union(one), "overwrite") == 2
    assert snaps.read().count() == 2 and snaps.read(1).count() == 16
    ch = [(r["change"], r["shelf"], r["slot"]) for r in snaps.changes(1, 2).collect()]
    # The kept row counts once; its copy is new.
    assert sorted(ch) == sorted([("added", "a0", 0)] + [("removed", r[0], r[1]) for r in FIRST[1:] + LATER])
    snaps.changes(1, 2).write.parquet(scratch_dir(spark, "changes-out"))  # no void columns
    plan = snaps.changes(1, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_log_entries_hold_their_own_folder_only(spark):
    snaps = fresh_table(spark, "snap-log")
    for k in range(4):
        snaps.commit(spark.createDataFrame([("a", k, "x", 1.0)], SHELF))
    assert all(len(r["dirs"]) == 1 for r in snaps.log().collect())
    assert [snaps.read(k).count() for k in range(4)] == [1, 2, 3, 4]


def test_append_that_does_not_fit_is_refused(spark):
    snaps = fresh_table(spark, "snap-merge")
    snaps.commit(spark.createDataFrame(FIRST, SHELF), "overwrite")
    for rows, schema in ((LATER, SHELF + ", since string"), ([("a", "one")], "shelf string, slot string"), ([(1 << 40,)], "slot long")):
        with pytest.raises(SchemaMismatch):
            snaps.commit(spark.createDataFrame(rows, schema))
    with pytest.raises(SchemaMismatch):
        snaps.commit(spark.createDataFrame([(1, 2)], "slot int, x int").toDF("slot", "SLOT"))
    assert snaps.history().count() == 1


def test_names_match_by_the_session_case_rule(spark):
    snaps = fresh_table(spark, "snap-case")
    snaps.commit(spark.createDataFrame([("a", 1)], "Shelf string, slot int"), "overwrite")
    snaps.commit(spark.createDataFrame([(2, "b")], "SLOT int, sHELF string"), merge_schema=True)
    assert snaps.read().columns == ["Shelf", "slot"] and sorted(map(tuple, snaps.read().collect())) == [("a", 1), ("b", 2)]


def test_numbers_widen_and_nested_fields_are_added(spark):
    snaps = fresh_table(spark, "snap-wide")
    snaps.commit(spark.createDataFrame([(1, 0.5, (1, "x"))], "n int, w float, s struct<k: int, t: string>"), "overwrite")
    snaps.commit(spark.createDataFrame([(1 << 40, 0.1, (2, "y", 3.0))], "n long, w double, s struct<k: int, t: string, v: double>"), merge_schema=True)
    snaps.commit(spark.createDataFrame([(7,)], "n int"))  # narrower values fit
    rows = {r["n"]: r for r in snaps.read().collect()}
    assert set(rows) == {1, 1 << 40, 7} and rows[1]["w"] == 0.5 and rows[1]["s"]["v"] is None and rows[1 << 40]["s"]["v"] == 3.0
    assert rows[7]["s"] is None
    assert snaps.read(0).schema["n"].dataType.simpleString() == "int"


def test_changes_of_type_and_maps_at_any_depth(spark):
    snaps = fresh_table(spark, "snap-map")
    schema = "id long, m map<string,int>, a array<map<string,int>>"
    snaps.commit(spark.createDataFrame([(1, {"a": 1, "b": 2}, [{"x": 1}]), (2, None, None)], schema), "overwrite")
    snaps.commit(spark.createDataFrame([(1, {"b": 2, "a": 1}, [{"x": 1}]), (2, {}, None)], schema), "overwrite")
    got = [(r["change"], r["id"], r["m"]) for r in snaps.changes(0, 1).collect()]
    assert sorted(got, key=str) == sorted([("added", 2, {}), ("removed", 2, None)], key=str)
    snaps.commit(spark.createDataFrame([("1", "x")], "id string, m string"), "overwrite")
    text = snaps.changes(1, 2)
    assert dict(text.dtypes)["id"] == "string" and dict(text.dtypes)["a"] == "array<map<string,int>>"
    got = {(r["change"], r["id"]): r["m"] for r in text.collect()}
    assert json.loads(got.pop(("removed", "1"))) == {"a": 1, "b": 2}
    assert got == {("added", "1"): "x", ("removed", "2"): "{}"}


# --- streams -------------------------------------------------------------------------


def test_windowed_stream_equals_batch_on_closed_windows(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    aggs = lambda: [F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total")]
    batch = W.windowed(events, "ts", "1 hour", aggs())
    stream = stream_plans._run(
        spark, W.windowed(stream_plans._events_stream(spark, SF_SMALL), "ts", "1 hour", aggs(), delay="1 hour"), "t"
    )
    cutoff = events.agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("window_end") <= F.lit(cutoff) - F.expr("INTERVAL 1 HOUR"))
    cols = ["window_start", "window_end", "n", "total"]
    assert sorted(closed.select(cols).collect()) == sorted(stream.select(cols).collect())


def test_sessions_batch_and_gap_rule(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:20:00"), (1, "2024-01-01 00:50:00"), (2, "2024-01-01 00:00:00")],
        "k long, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = W.sessions(df, "k", "ts", "30 minutes", [F.count(F.lit(1)).alias("n")]).orderBy("k", "session_start").collect()
    # 00:20 -> 00:50 is a gap of exactly 30 minutes: Spark keeps it in the session
    # (only a larger gap starts a new one).
    assert [(r["k"], r["n"]) for r in out] == [(1, 3), (2, 1)]
    assert str(out[0]["session_end"]) == "2024-01-01 01:20:00"
    split = df.union(spark.createDataFrame([(1, "2024-01-01 01:20:01")], "k long, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")))
    out = W.sessions(split, "k", "ts", "30 minutes", [F.count(F.lit(1)).alias("n")]).where("k = 1").count()
    assert out == 2


def test_late_report_adds_up(spark):
    # Every row either went through the stream or was counted as late.
    root = scratch_dir(spark, "late-sum")
    src = stream_plans._arrive(spark, SF_SMALL)
    progress = runner.run_available(W.dedup(src, "event_id", "ts", "1 hour"), f"{root}/sink", f"{root}/ckpt")
    report = W.late_report(spark, progress).orderBy("batch").collect()
    kept = runner.read_sink(spark, f"{root}/sink").count()
    assert [r["batch"] for r in report] == list(range(10))
    assert sum(r["rows"] for r in report) == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert kept == sum(r["rows"] - r["late_rows"] for r in report) and sum(r["late_rows"] for r in report) > 0
    assert all(a["watermark"] <= b["watermark"] for a, b in zip(report, report[1:], strict=False))


def test_sink_keeps_a_column_named_batch(spark):
    root = scratch_dir(spark, "batch-column")
    spark.range(5).select("id", (F.col("id") * 11).alias("batch")).write.parquet(f"{root}/in")
    src = runner.file_stream(spark, f"{root}/in", "id long, batch long")
    runner.run_available(src, f"{root}/sink", f"{root}/ckpt")
    assert sorted(r["batch"] for r in runner.read_sink(spark, f"{root}/sink", src.schema).collect()) == [0, 11, 22, 33, 44]
    with pytest.raises(ValueError):
        runner.run_available(src.withColumn(runner.BATCH, F.lit(1)), f"{root}/s2", f"{root}/c2")


def test_sessions_of_a_hot_key_merge_before_the_shuffle(spark):
    key = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    own = stream_plans._session(spark, SF_SMALL, **W.SESSION_CONF)
    W.sessions(stream_plans._events_stream(own, SF_SMALL), "user_id", "ts", "1 hour", [F.count(F.lit(1)).alias("n")])
    # The setting is the stream's session's own; the caller's stays as it was.
    assert own.conf.get(key) == "true" and spark.conf.get(key) == "false"
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("user_id", F.lit(1))
    out = W.sessions(events, "user_id", "ts", "10 minutes", [F.count(F.lit(1)).alias("n")])
    assert out.agg(F.sum("n")).first()[0] == events.count()


def test_dedup_batch_and_stream(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    doubled = events.unionByName(events)
    assert W.dedup(doubled, "event_id", "ts").count() == events.count()
    assert stream_plans.stream_dedup(spark, SF_SMALL).count() == events.count()


def test_resume_equals_one_run(spark):
    assert stream_plans.stream_resume(spark, SF_SMALL).count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


# --- event logs ----------------------------------------------------------------------


def _spark_log(root: str, extra: str = "") -> None:
    """Run a small Spark application in a child process with event logging on."""
    import subprocess
    import sys
    import textwrap

    script = textwrap.dedent(
        f"""
        from pyspark.sql import SparkSession
        b = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "{root}"))
        {extra}
        s = b.getOrCreate()
        df = s.range(0, 100000, numPartitions=4)
        df.groupBy((df.id % 3).alias("k")).count().collect()
        s.range(0, 1000, numPartitions=3).selectExpr("sum(id)").collect()
        s.stop()
        """
    )
    subprocess.run([sys.executable, "-c", script], check=True, timeout=300, capture_output=True)


def test_eventlog_reader_on_real_log(spark):
    # Spark writes its own event log; read it back with our reader.
    root = tempfile.mkdtemp(prefix="evlog-", dir="/tmp")
    _spark_log(root)
    logs = [os.path.join(root, f) for f in os.listdir(root)]
    assert logs
    tasks = ES.task_metrics(ES.read_log_lines(spark, logs))
    assert tasks.count() >= 7
    assert tasks.where("run_ms is null or launch_time is null or executor_id is null").count() == 0
    assert EL.stage_skew(tasks).count() >= 2


def test_eventlog_reader_on_rolling_compressed_log(spark):
    root = tempfile.mkdtemp(prefix="evlog-roll-", dir="/tmp")
    _spark_log(
        root,
        'b = b.config("spark.eventLog.rolling.enabled", "true").config("spark.eventLog.compress", "true")'
        '.config("spark.eventLog.compression.codec", "zstd")',
    )
    folders = [f for f in os.listdir(root) if f.startswith("eventlog_v2_")]
    assert len(folders) == 1
    parts = os.listdir(os.path.join(root, folders[0]))
    assert any(p.endswith(".zstd") for p in parts)
    tasks = ES.read_task_metrics(spark, f"{root}/eventlog_v2_*/events_*")
    assert tasks.count() >= 7
    assert {r["app"] for r in tasks.select("app").distinct().collect()} == {folders[0][len("eventlog_v2_"):]}


def test_eventlog_reports_on_derived_lines(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    lines = D.task_end_lines(events).withColumn("app", F.lit("a"))
    tasks = ES.task_metrics(lines)
    assert tasks.count() == events.count()  # TaskStart lines are skipped
    fails = EL.failures(tasks).agg(F.sum("n")).first()[0]
    assert fails == events.where("event_type = 'error'").count()
    f = EL.findings(spark, EL.stage_metrics_long(tasks), [("gc_share", 0.0, "info")])
    assert f.count() == 10  # every stage has some GC time


def test_the_derived_log_is_written_in_small_compressed_parts(spark, monkeypatch, tmp_path):
    from tablelab.plans import eventlog_plans as P

    monkeypatch.setattr(P, "PART_LINES", 500, raising=False)
    rows = [(k, datetime.datetime(2024, 1, 1, 0, 0, k % 60), k * 7 % 1009, ("view", "error", "purchase")[k % 3], k * 1.5) for k in range(2000)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    log = f"{P._write_log(spark, str(tmp_path)).removeprefix('file:')}/eventlog_v2_{P.APP}"
    lines = D.task_end_lines(spark.read.parquet(f"{tmp_path}/events.parquet"))
    parts = glob.glob(f"{log}/part-*")
    assert len(parts) == 8 and all(spark.read.text(p).count() == 500 for p in parts)
    assert 5 * sum(map(os.path.getsize, parts)) < lines.agg(F.sum(F.length("value") + 1)).first()[0]
    read, plain = ES.read_task_metrics(spark, log), ES.task_metrics(lines.withColumn("app", F.lit(P.APP)))
    assert read.count() == 2000 and read.exceptAll(plain).count() == 0


# --- Python batches ---------------------------------------------------------------------


class _Unpicklable:
    def __reduce__(self):
        raise TypeError("cannot pickle")


def test_setup_builds_resource_inside_task(spark):
    df = spark.range(100).withColumnRenamed("id", "x")

    def fn(pdf, res):
        assert isinstance(res, _Unpicklable)
        return pd.DataFrame({"y": pdf["x"] * 2})

    out = U.map_vectorized(df, fn, "y long", setup=_Unpicklable)
    assert out.agg(F.sum("y")).first()[0] == 9900


def test_map_catching_isolates_bad_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "x")

    def fn(row, _res):
        if row["x"] % 97 == 5:
            raise ZeroDivisionError("bad row " + "x" * 2000)
        return {"x": row["x"], "y": row["x"] + 1}

    def whole(batch, _res):
        if any(x % 97 == 5 for x in batch.column("x").to_pylist()):
            raise ZeroDivisionError
        return pa.RecordBatch.from_arrays([batch.column("x"), pc.add(batch.column("x"), 1)], ["x", "y"])

    for batch_fn in (None, whole):
        ok, errors = U.split_errors(U.map_catching(df, fn, "x long, y long", batch_fn=batch_fn))
        bad_ids = sorted(json.loads(r["input"])["x"] for r in errors.collect())
        assert bad_ids == [i for i in range(1000) if i % 97 == 5]
        assert ok.count() + errors.count() == 1000 and ok.where("y <> x + 1").count() == 0
        assert {(r["error_class"], len(r["error_message"])) for r in errors.collect()} == {("ZeroDivisionError", 2008)}


def test_map_catching_keeps_the_input_exactly(spark):
    schema = "d double, n long, b binary, t timestamp_ntz, `a.b` string, __input string"
    stamp = datetime.datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(0.12345678901234567, 2**53 + 1, b"\xff\x00", stamp, None, "own")], schema)

    def fn(row, _res):
        raise KeyError(row["b"])

    _, errors = U.split_errors(U.map_catching(df, fn, "d double"))
    got = json.loads(errors.first()["input"])
    assert got == {"d": 0.12345678901234567, "n": 2**53 + 1, "b": "/wA=", "t": "2024-01-02T03:04:05.678901", "a.b": None, "__input": "own"}


def test_map_catching_results_that_do_not_fit(spark):
    df = spark.range(10).withColumnRenamed("id", "x")

    def fn(row, _res):
        x = row["x"]
        return None if x == 1 else [{"y": x}, {"y": x}] if x == 2 else {"z": x} if x == 3 else {"y": "text"} if x == 4 else {"y": x}

    ok, errors = U.split_errors(U.map_catching(df, fn, "y long"))
    assert sorted(r["y"] for r in ok.collect()) == [0, 2, 2, 5, 6, 7, 8, 9]
    assert sorted(json.loads(r["input"])["x"] for r in errors.collect()) == [3, 4]


def test_python_operators_plan_without_running(spark):
    spark.sparkContext.setJobGroup("lazy-udf", "planning only")
    try:
        df = spark.range(100).repartition(3)
        U.map_catching(df, lambda r, _: r, "id long")
        U.map_vectorized(df, lambda b, _: b, "id long")
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy-udf")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("codec", ["lz4", "snappy", "lzf"])
def test_eventlog_parts_that_cannot_be_decoded_raise(spark, codec):
    root = tempfile.mkdtemp(prefix=f"evlog-{codec}-", dir="/tmp")
    _spark_log(root, f'b = b.config("spark.eventLog.compress", "true").config("spark.eventLog.compression.codec", "{codec}").config("spark.eventLog.rolling.enabled", "false")')
    with pytest.raises(ES.UndecodableLog, match=codec):
        ES.read_task_metrics(spark, root)


def test_lines_that_are_no_log_raise(spark):
    root = tempfile.mkdtemp(prefix="evlog-text-", dir="/tmp")
    with open(f"{root}/app-1", "w") as f:
        f.write('{"Event":"SparkListenerTaskEnd"}\n\nnot json\n')
    with pytest.raises(Exception, match="not a line of an event log"):
        ES.read_log_lines(spark, f"{root}/app-1").collect()


def test_map_catching_on_a_stream(spark):
    root = scratch_dir(spark, "udf-stream")
    spark.range(200).withColumnRenamed("id", "x").write.parquet(f"{root}/in")
    src = runner.file_stream(spark, f"{root}/in", "x long")

    def fn(row, _res):
        if row["x"] == 13:
            raise KeyError("13")
        return row

    runner.run_available(U.map_catching(src, fn, "x long"), f"{root}/sink", f"{root}/ckpt")
    ok, errors = U.split_errors(runner.read_sink(spark, f"{root}/sink"))
    assert ok.count() == 199 and errors.count() == 1


def test_stage_percentiles_are_exact_for_large_stages(spark):
    n = 200_001
    tasks = spark.range(n + 3).selectExpr(
        "'a' as app", "id div 200001 as stage_id", "0L as stage_attempt",
        "case when id < 200001 then (id * 7919) % 200001 * 3 when id < 200003 then 1L end as run_ms",
        "1L as disk_spilled", "2L as memory_spilled", "0L as gc_ms",
    )
    tasks = tasks.union(tasks.where("stage_id = 0 and run_ms = 300000").withColumn("stage_id", F.lit(2)).withColumn("run_ms", F.lit(None).cast("long")))
    got = {r["stage_id"]: r.asDict() for r in EL.stage_skew(tasks).collect()}
    assert (got[0]["tasks"], got[0]["median_ms"], got[0]["p95_ms"], got[0]["max_ms"]) == (n, 300_000.0, 570_000.0, 600_000)
    assert got[0]["max_over_median"] == 2.0 and got[0]["skewed"] is False
    assert (got[1]["tasks"], got[1]["median_ms"], got[1]["p95_ms"]) == (3, 1.0, 1.0)
    assert (got[2]["tasks"], got[2]["median_ms"], got[2]["max_ms"], got[2]["skewed"]) == (1, None, None, None)
    long = {(r["stage_id"], r["metric"]): r["value"] for r in EL.stage_metrics_long(tasks).collect()}
    assert long[0, "max_over_median"] == 2.0 and long[0, "p95_ms"] == 570_000.0
    assert long[0, "disk_spilled"] == n and long[0, "memory_spilled"] == 2 * n


def test_progress_of_every_batch_is_kept_and_files_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(stream_plans, "FILE_BYTES", 24 * 30, raising=False)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "3")
    try:
        root = scratch_dir(spark, "progress-test")
        src = stream_plans._arrive(spark, SF_SMALL + "/.")
        progress = runner.run_available(W.dedup(src, "event_id", "ts", "1 hour"), f"{root}/sink", f"{root}/ckpt")
    finally:
        spark.conf.set(key, before)
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows = {r["batch"]: r["count"] for r in stream_plans.late_arrivals(events).groupBy("batch").count().collect()}
    assert [(p["batchId"], p["numInputRows"]) for p in progress] == sorted(rows.items())
    shared, files = session_fixture(spark, f"arrivals:{SF_SMALL}/.", None)
    assert files == -(-max(rows.values()) // 30) > 2
    for b in rows:
        assert len(glob.glob(f"{shared.removeprefix('file:')}/input/b{b:02d}/*.parquet")) == files


def test_a_row_repeated_ten_million_times(spark):
    from tablelab.operators.snapshots import Snapshots
    from tablelab.session import scratch_dir

    snaps = Snapshots(spark, scratch_dir(spark, "repeats"))
    n = 10_000_001
    snaps.commit(spark.range(n).selectExpr("7 as v"), "overwrite")
    snaps.commit(spark.range(3).selectExpr("7 as v"), "overwrite")
    changes = snaps.changes(0, 1).groupBy("change", "v").count().collect()
    assert [tuple(r) for r in changes] == [("removed", 7, n - 3)]
