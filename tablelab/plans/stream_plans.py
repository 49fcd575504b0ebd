"""Registered plans: Structured Streaming (build-list step 7).

Each plan runs a real stream over the driver's ``events`` file (file source,
``availableNow``) into a fresh sink in shared scratch and returns the sink as a
table.  Append mode emits a window only once the watermark has passed it, so the
oracles keep the windows that end at or before ``max(ts) - delay``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelab.functions import exact_sum
from tablelab.plans.registry import register
from tablelab.session import scratch_dir, session_fixture, table
from tablelab.sources import derived as D
from tablelab.streaming import late as L
from tablelab.streaming import runner as R
from tablelab.streaming import state as ST
from tablelab.streaming import windows as W


#: Rows of state that one partition takes: a few tens of MB.
STATE_ROWS = 250_000


def _session(spark, sf_dir, **conf):
    """A session for a stream over events.  Its state has at most a row per event; every
    micro-batch visits each of its partitions, so there are no more than that takes."""
    rows = table(spark, sf_dir, "events").count()
    return R.stream_session(spark, rows // STATE_ROWS + 1, **conf)


def _events_stream(spark, sf_dir, **kw):
    schema = table(spark, sf_dir, "events").schema
    return R.file_stream(spark, sf_dir, schema, glob="events.parquet", **kw)


def _run(spark, df, name):
    """Runs the stream ``df``, of a session of its own, and returns its sink."""
    root = scratch_dir(spark, name)
    R.run_available(df, f"{root}/sink", f"{root}/checkpoint")
    return R.read_sink(spark, f"{root}/sink", df.schema)


def _aggs():
    return [F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total")]


@register(
    "stream_tumbling",
    """
with w as (select time_bucket(interval '1 hour', ts) as window_start, count(*) as n,
                  cast(sum(cast(value as decimal(38,2))) as double) as total
           from events group by 1)
select window_start, window_start + interval '1 hour' as window_end, n, total from w
where window_start + interval '1 hour' <= (select max(ts) from events) - interval '1 hour'
""",
)
def stream_tumbling(spark, sf_dir):
    out = W.windowed(_events_stream(_session(spark, sf_dir), sf_dir), "ts", "1 hour", _aggs(), delay="1 hour")
    return _run(spark, out, "tumbling")


@register(
    "stream_sliding",
    """
with k as (select * from events, range(4) r(k)),
w as (select time_bucket(interval '6 hours', ts) - k * interval '6 hours' as window_start, count(*) as n,
             cast(sum(cast(value as decimal(38,2))) as double) as total
      from k group by 1)
select window_start, window_start + interval '1 day' as window_end, n, total from w
where window_start + interval '1 day' <= (select max(ts) from events) - interval '1 hour'
""",
)
def stream_sliding(spark, sf_dir):
    out = W.windowed(_events_stream(_session(spark, sf_dir), sf_dir), "ts", "1 day", _aggs(), slide="6 hours", delay="1 hour")
    return _run(spark, out, "sliding")


@register(
    "stream_session",
    """
with e as (
  select user_id, ts, value,
         case when ts - lag(ts) over (partition by user_id order by ts) <= interval '6 hours' then 0 else 1 end as brk
  from events),
s as (select *, sum(brk) over (partition by user_id order by ts rows unbounded preceding) as sid from e)
select user_id, min(ts) as session_start, max(ts) + interval '6 hours' as session_end, count(*) as n,
       cast(sum(cast(value as decimal(38,2))) as double) as total
from s group by user_id, sid
having max(ts) + interval '6 hours' <= (select max(ts) from events) - interval '1 hour'
""",
)
def stream_session(spark, sf_dir):
    out = W.sessions(_events_stream(_session(spark, sf_dir, **W.SESSION_CONF), sf_dir), "user_id", "ts", "6 hours", _aggs(), delay="1 hour")
    return _run(spark, out, "session")


def _held():
    """The aggregates of ``_aggs`` from their buffers in the state."""
    return {"n": F.col("value.count"), "total": F.col("value.sum").cast("double")}


@register(
    "state_windows",
    """
with w as (select time_bucket(interval '1 hour', ts) as window_start, count(*) as n,
                  cast(sum(cast(value as decimal(38,2))) as double) as total from events group by 1)
select window_start, window_start + interval '1 hour' as window_end, n, total,
       window_start + interval '1 hour' > (select max(ts) from events) - interval '1 hour' as still_open
from w
""",
)
def state_windows(spark, sf_dir):
    # Windows that a finished stream has emitted, and those its state still holds.
    root = scratch_dir(spark, "state-windows")
    out = W.windowed(_events_stream(_session(spark, sf_dir), sf_dir), "ts", "1 hour", _aggs(), delay="1 hour")
    R.run_available(out, f"{root}/sink", f"{root}/checkpoint")
    emitted = R.read_sink(spark, f"{root}/sink", out.schema)
    held = ST.open_windows(spark, f"{root}/checkpoint", _held())
    return emitted.withColumn("still_open", F.lit(False)).unionByName(held.withColumn("still_open", F.lit(True)))


@register(
    "state_sessions",
    """
with e as (
  select user_id, ts, value,
         case when ts - lag(ts) over (partition by user_id order by ts) <= interval '6 hours' then 0 else 1 end as brk
  from events),
s as (select *, sum(brk) over (partition by user_id order by ts rows unbounded preceding) as sid from e)
select user_id, min(ts) as session_start, max(ts) + interval '6 hours' as session_end, count(*) as n,
       cast(sum(cast(value as decimal(38,2))) as double) as total,
       max(ts) + interval '6 hours' > (select max(ts) from events) - interval '1 hour' as still_open
from s group by user_id, sid
""",
)
def state_sessions(spark, sf_dir):
    root = scratch_dir(spark, "state-sessions")
    own = _session(spark, sf_dir, **W.SESSION_CONF)
    out = W.sessions(_events_stream(own, sf_dir), "user_id", "ts", "6 hours", _aggs(), delay="1 hour")
    R.run_available(out, f"{root}/sink", f"{root}/checkpoint")
    emitted = R.read_sink(spark, f"{root}/sink", out.schema)
    held = ST.open_sessions(spark, f"{root}/checkpoint", "user_id", _held())
    return emitted.withColumn("still_open", F.lit(False)).unionByName(held.withColumn("still_open", F.lit(True)))


_EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


@register("stream_dedup", f"select {_EVENT_COLS} from events")
def stream_dedup(spark, sf_dir):
    # One folder holds all rows, another repeats every third; a second run after a
    # restart with no new input must emit nothing more.
    root = scratch_dir(spark, "dedup")
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{root}/input/a")
    events.where(F.pmod("event_id", F.lit(3)) == 0).write.parquet(f"{root}/input/b")
    src = R.file_stream(_session(spark, sf_dir), f"{root}/input/*", events.schema)
    out = W.dedup(src, "event_id", "ts", delay="1 day")
    for _ in range(2):
        R.run_available(out, f"{root}/sink", f"{root}/checkpoint")
    return R.read_sink(spark, f"{root}/sink", events.schema)


@register("stream_resume", f"select {_EVENT_COLS} from events")
def stream_resume(spark, sf_dir):
    # Run on the first half, add the second half, run again: equals one full run.
    root = scratch_dir(spark, "resume")
    events = table(spark, sf_dir, "events")
    half = events.agg(F.max("event_id")).scalar()
    first = events.where(F.col("event_id") <= half / 2)
    second = events.where(~(F.col("event_id") <= half / 2))
    first.write.parquet(f"{root}/input/part1")
    src = R.file_stream(spark, f"{root}/input/*", events.schema)
    R.run_available(src, f"{root}/sink", f"{root}/checkpoint")
    second.write.parquet(f"{root}/input/part2")
    R.run_available(src, f"{root}/sink", f"{root}/checkpoint")
    return R.read_sink(spark, f"{root}/sink", events.schema)


BATCHES = 10
#: Bytes of an arrivals file, and about those of a row in it.
FILE_BYTES, ROW_BYTES = 64 << 20, 24

_LATE_SQL = """
with e as (
  select event_id * 10 // (select count(*) from events) as batch,
         case when event_id % 20 = 0 then ts - interval '10 days' else ts end as ts
  from events),
b as (select batch, max(ts) as mx from e group by batch),
w as (select batch,
             max(mx) over (order by batch rows between unbounded preceding and 1 preceding) - interval '1 hour' as watermark,
             max(mx) over (order by batch rows between unbounded preceding and 2 preceding) - interval '1 hour' as late_before
      from b)
select e.batch, count(*) as rows,
       cast(count_if(coalesce(e.ts <= w.late_before, false)) as bigint) as late_rows,
       coalesce(date_trunc('millisecond', max(w.watermark)), timestamp '1970-01-01') as watermark
from e join w on e.batch = w.batch group by e.batch
"""


def late_arrivals(events):
    """``events`` in ten arrival batches, every 20th row 10 days late."""
    n = events.agg(F.count(F.lit(1))).scalar()
    shifted = F.when(F.pmod("event_id", F.lit(20)) == 0, F.col("ts") - F.expr("INTERVAL 10 DAYS")).otherwise(F.col("ts"))
    return events.select(
        "event_id", F.floor(F.col("event_id") * BATCHES / n).cast("long").alias("batch"),
        shifted.alias("ts"), "user_id", "value",
    )


def _arrive(spark, sf_dir, session=None):
    """A stream of the arrivals in ``session``, one micro-batch per arrival batch (the input is written
    once per application).

    One pass splits them into a folder per batch.  The stream takes files in the order of
    their times, so batches are then moved in one after another, each read once and
    written as the same number of files, which a trigger takes together.  The number
    follows the largest batch, so that writing and reading a batch spread over tasks."""
    arrivals = late_arrivals(table(spark, sf_dir, "events"))
    schema = arrivals.drop("batch").schema

    def write():
        root = scratch_dir(spark, "arrivals")
        arrivals.write.partitionBy("batch").parquet(f"{root}/staged")
        largest = spark.read.parquet(f"{root}/staged").groupBy("batch").count().agg(F.max("count")).first()[0] or 0
        files = max(2, -(-largest * ROW_BYTES // FILE_BYTES))
        for b in range(BATCHES):
            one = spark.read.schema(schema).parquet(f"{root}/staged/batch={b}")
            one.repartition(files).write.parquet(f"{root}/input/b{b:02d}")
        return root, files

    root, files = session_fixture(spark, f"arrivals:{sf_dir}", write)
    return R.file_stream(session or spark, f"{root}/input/*", schema, max_files_per_trigger=files)


@register("late_report", _LATE_SQL)
def late_report(spark, sf_dir):
    # The engine's own count of late rows, from the progress of a real stream.
    root = scratch_dir(spark, "late-report")
    out = W.dedup(_arrive(spark, sf_dir, _session(spark, sf_dir)), "event_id", "ts", delay="1 hour")
    progress = R.run_available(out, f"{root}/sink", f"{root}/checkpoint")
    return W.late_report(spark, progress)


@register(
    "late_rows",
    """
with e as (
  select event_id, user_id, value, event_id * 10 // (select count(*) from events) as batch,
         case when event_id % 20 = 0 then ts - interval '10 days' else ts end as ts
  from events),
b as (select batch, max(ts) as mx from e group by batch),
w as (select batch, date_trunc('millisecond', max(mx) over (order by batch rows between unbounded preceding and 1 preceding))
                    - interval '1 hour' as watermark from b),
u as (select user_id % 4 as shard, batch, max(ts) as mx from e group by all),
l as (select shard, batch, max(mx) over (partition by shard order by batch rows between unbounded preceding and 1 preceding) as latest from u)
select e.event_id, e.ts, e.user_id, e.value, l.shard, coalesce(e.ts <= w.watermark, false) as late, w.watermark, l.latest
from e join w using (batch) join l on l.shard = e.user_id % 4 and l.batch = e.batch
""",
)
def late_rows(spark, sf_dir):
    # Every arrival goes on, the late ones marked: rows in = on time + late.
    # Python is called for each key and micro-batch, so the key is a shard, not a user.
    own = _session(spark, sf_dir, **L.STATE_CONF)
    arrivals = _arrive(spark, sf_dir, own).withColumn("shard", F.pmod("user_id", F.lit(4)))
    return _run(spark, L.mark_late(arrivals, "shard", "ts", "1 hour", idle="60 days"), "late-rows")


_LATE_WINDOWS_SQL = """
with e as (
  select event_id * 10 // (select count(*) from events) as batch, value,
         case when event_id % 20 = 0 then ts - interval '10 days' else ts end as ts
  from events),
b as (select batch, max(ts) as mx from e group by batch),
w as (select batch, max(mx) over (order by batch rows between unbounded preceding and 2 preceding)
                    - interval '1 hour' as watermark from b),
k as (select time_bucket(interval '1 hour', e.ts) as window_start, e.value
      from e join w on e.batch = w.batch
      where not coalesce(time_bucket(interval '1 hour', e.ts) + interval '1 hour' <= w.watermark, false))
select window_start, window_start + interval '1 hour' as window_end, count(*) as n,
       cast(sum(cast(value as decimal(38,2))) as double) as total
from k group by window_start
having window_start + interval '1 hour' <= (select max(ts) from e) - interval '1 hour'
"""


@register("stream_late_windows", _LATE_WINDOWS_SQL)
def stream_late_windows(spark, sf_dir):
    # The oracle: rows whose window was open when they arrived, in windows that closed.
    out = W.windowed(_arrive(spark, sf_dir, _session(spark, sf_dir)), "ts", "1 hour", _aggs(), delay="1 hour")
    return _run(spark, out, "late-windows")


@register(
    "stream_json_quarantine",
    """
with t as (
  select *, case event_id % 12 when 2 then 'not_object' when 4 then 'not_json' when 7 then 'bad_type' end as reason from events)
select case when reason is null then event_id end as event_id,
       case when reason is null and event_id % 12 <> 10 then user_id end as user_id,
       case when reason is null then event_type end as event_type, reason
from t
""",
)
def stream_json_quarantine(spark, sf_dir):
    root = scratch_dir(spark, "json-stream")
    D.json_lines(table(spark, sf_dir, "events")).select("value").write.text(f"{root}/input")
    stream = R.bus_shape(spark.readStream.format("text").load(f"{root}/input"))
    R.quarantine_stream(stream, D.JSON_SCHEMA, f"{root}/good", f"{root}/bad", f"{root}/checkpoint")
    good = spark.read.parquet(f"{root}/good").select(
        "event_id", "user_id", "event_type", F.lit(None).cast("string").alias("reason")
    )
    bad = spark.read.parquet(f"{root}/bad").select(
        *[F.lit(None).cast(t).alias(c) for c, t in (("event_id", "long"), ("user_id", "long"), ("event_type", "string"))],
        "reason",
    )
    return good.unionByName(bad)

