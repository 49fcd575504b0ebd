"""Late rows of a stream are marked, not dropped."""

import datetime as dt
import os

import pytest

from tablelab.session import scratch_dir
from tablelab.streaming import late as L
from tablelab.streaming import runner as R
from tablelab.streaming import windows as W

START = dt.datetime(2024, 3, 1)
SCHEMA = "`odd name` long, ts timestamp_ntz, _k string, big long"


def hours(h):
    return None if h is None else START + dt.timedelta(hours=h)


def run(spark, batches, **kw):
    """One file and micro-batch for each of ``batches``; rows are (id, hour, key)."""
    own = R.stream_session(spark, 1, **L.STATE_CONF)
    root = scratch_dir(spark, "late-test")
    for b, rows in enumerate(batches):
        path = f"{root}/input/b{b}"
        spark.createDataFrame([(i, hours(h), k, 2**60 + i) for i, h, k in rows], SCHEMA).coalesce(1).write.parquet(path)
        for f in os.listdir(path.removeprefix("file:")):  # files are taken in the order of their times
            os.utime(f"{path.removeprefix('file:')}/{f}", (b + 1, b + 1))
    stream = R.file_stream(own, f"{root}/input/*", SCHEMA, max_files_per_trigger=1)
    out = L.mark_late(stream, "_k", "ts", "1 hour", **kw)
    R.run_available(out, f"{root}/sink", f"{root}/checkpoint")
    rows = R.read_sink(spark, f"{root}/sink", out.schema).collect()
    assert all(r["big"] == 2**60 + r["odd name"] for r in rows)
    return {r["odd name"]: (r["late"], r["watermark"], r["latest"]) for r in rows}, len(rows)


def test_rows_in_are_rows_on_time_and_late(spark):
    batches = [
        [(1, 0, "a"), (2, 10, "a"), (3, 5, None)],
        [(4, 9, "a"), (5, 8, "b"), (6, 20, "b"), (7, None, "a"), (8, 3, None)],
        [(9, 19, "a"), (10, 21, "b"), (10, 21, "b"), (11, 2, "c")],
    ]
    got, n = run(spark, batches)
    assert n == sum(map(len, batches))
    assert {k for k, v in got.items() if v[0]} == {4, 8, 5, 9, 11}
    assert got[2][1:] == (None, None) and got[4][1:] == (hours(9), hours(10)) and got[7] == (False, hours(9), hours(10))
    assert got[8][2] == hours(5) and got[10][1:] == (hours(19), hours(20)) and got[11][2] is None


def test_idle_keys_are_forgotten(spark):
    batches = [[(1, 0, "a"), (2, 0, "b")], [(3, 50, "b")], [(4, 60, "b")], [(5, 61, "a"), (6, 61, "b")]]
    got, _ = run(spark, batches, idle="24 hours")
    assert got[5][2] is None and got[6][2] == hours(60)


def test_a_batch_and_clashing_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        L.mark_late(spark.createDataFrame([], "ts timestamp_ntz, k long"), "k", "ts", "1 hour")
    stream = R.file_stream(spark, str(tmp_path), "ts timestamp_ntz, Late long")
    with pytest.raises(ValueError):
        L.mark_late(stream, "Late", "ts", "1 hour")


def test_streams_leave_the_callers_settings_alone(spark):
    before = dict(spark.conf.getAll)
    own = R.stream_session(spark, 3, **L.STATE_CONF, **W.SESSION_CONF)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert dict(spark.conf.getAll) == before
