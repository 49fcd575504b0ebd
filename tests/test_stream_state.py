"""Open windows and sessions read from a stream's state."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tablelab.session import scratch_dir
from tablelab.streaming import runner as R
from tablelab.streaming import state as ST
from tablelab.streaming import windows as W

ZERO = dt.datetime(2024, 5, 1)
SCHEMA = "shop string, ts timestamp_ntz, paid long"


def test_emitted_and_open_rows_after_each_batch(spark):
    root = scratch_dir(spark, "state-test")
    batches = [[("a", h, 1) for h in range(6)] + [("b", 2, 5)], [("a", 9, 1), (None, 8, 7)], [("b", 30, 2)]]
    for b, rows in enumerate(batches):
        path = f"{root}/input/b{b}"
        spark.createDataFrame([(s, ZERO + dt.timedelta(hours=h), p) for s, h, p in rows], SCHEMA).coalesce(1).write.parquet(path)
        for f in os.listdir(path.removeprefix("file:")):
            os.utime(f"{path.removeprefix('file:')}/{f}", (b + 1, b + 1))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("paid").alias("paid")]
    held = {"n": F.col("value.count"), "paid": F.col("value.sum")}
    source = spark.read.parquet(f"{root}/input/*")
    for name, make, read in (
        ("w", lambda df: W.windowed(df, "ts", "3 hours", aggs, delay="2 hours", keys="shop"), lambda c, b: ST.open_windows(spark, c, held, "shop", b)),
        ("s", lambda df: W.sessions(df, "shop", "ts", "90 minutes", aggs, delay="2 hours"), lambda c, b: ST.open_sessions(spark, c, "shop", held, b)),
    ):
        stream = R.file_stream(R.stream_session(spark, 2), f"{root}/input/*", SCHEMA, max_files_per_trigger=1)
        out = make(stream)
        R.run_available(out, f"{root}/{name}-sink", f"{root}/{name}-checkpoint")
        emitted = R.read_sink(spark, f"{root}/{name}-sink", out.schema)
        left = read(f"{root}/{name}-checkpoint", None)
        assert left.columns == emitted.columns == make(source).columns
        want = sorted(map(str, make(source).collect()))
        assert sorted(map(str, emitted.collect() + left.collect())) == want and left.count() == 1
        # After the first micro-batch nothing had been emitted: all of it was open.
        first = make(spark.read.parquet(f"{root}/input/b0"))
        assert sorted(map(str, read(f"{root}/{name}-checkpoint", 0).collect())) == sorted(map(str, first.collect()))
