"""Spark event logs (JSON lines) as a typed task table.

Only ``SparkListenerTaskEnd`` lines are parsed: a substring test on the raw line
drops everything else before ``from_json`` runs, so the parse cost follows the
number of tasks, not the size of the log.  Logs may be single files or rolling
folders (``eventlog_v2_*/events_*``).  The text source decodes zstd and plain parts.
Parts that Spark writes as lz4, lzf or snappy blocks have a framing of Spark's own,
which the text source would silently read as nothing: they are rejected by name.
Any other line that isn't JSON raises as well, so a log is never taken for empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TASK_END = "SparkListenerTaskEnd"


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


L, S, B = T.LongType(), T.StringType(), T.BooleanType()

# Fixed field names of the Spark event-log format (public listener JSON).
TASK_END_SCHEMA = _s(
    ("Event", S),
    ("Stage ID", L),
    ("Stage Attempt ID", L),
    ("Task Type", S),
    ("Task End Reason", _s(("Reason", S), ("Class Name", S), ("Description", S))),
    (
        "Task Info",
        _s(
            ("Task ID", L),
            ("Attempt", L),
            ("Launch Time", L),
            ("Finish Time", L),
            ("Executor ID", S),
            ("Host", S),
            ("Failed", B),
            ("Killed", B),
        ),
    ),
    (
        "Task Metrics",
        _s(
            ("Executor Run Time", L),
            ("Executor CPU Time", L),
            ("JVM GC Time", L),
            ("Memory Bytes Spilled", L),
            ("Disk Bytes Spilled", L),
            ("Peak Execution Memory", L),
            ("Input Metrics", _s(("Bytes Read", L), ("Records Read", L))),
            ("Shuffle Read Metrics", _s(("Fetch Wait Time", L), ("Remote Bytes Read", L), ("Local Bytes Read", L), ("Total Records Read", L))),
            ("Shuffle Write Metrics", _s(("Shuffle Bytes Written", L), ("Shuffle Records Written", L))),
        ),
    ),
)

TASK_COLUMNS = [
    "app", "stage_id", "stage_attempt", "task_id", "attempt", "executor_id", "host", "launch_time", "finish_time",
    "duration_ms", "run_ms", "cpu_ns", "gc_ms", "memory_spilled", "disk_spilled", "peak_memory", "input_bytes",
    "fetch_wait_ms", "remote_bytes_read", "local_bytes_read", "records_read", "shuffle_bytes_written", "reason",
    "error_class", "failed",
]


#: Endings of parts that the text source can't decode (fixed names of Spark's codecs).
UNDECODABLE = ("lz4", "lzf", "snappy")


class UndecodableLog(ValueError):
    pass


def read_log_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """value + app (the log file's folder or name) for every line of the logs.

    Raises ``UndecodableLog`` for a part in a codec that can't be read here, and, when the
    lines are read, for one that isn't a JSON object."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths)
    # One name per file of the log: its parts are listed by the read anyway.
    unread = [f for f in lines.inputFiles() if f.removesuffix(".inprogress").rsplit(".", 1)[-1].lower() in UNDECODABLE]
    if unread:
        raise UndecodableLog(f"{len(unread)} parts in a codec the text source can't decode (of {', '.join(UNDECODABLE)}), such as {unread[0]}")
    path = F.col("_metadata.file_path")
    parts = F.split(path, "/")
    folder = F.element_at(parts, -2)
    app = F.when(folder.startswith("eventlog_v2_"), F.substring(folder, 13, 1 << 20)).otherwise(F.element_at(parts, -1))
    broken = F.concat(F.lit("not a line of an event log, in "), path)
    fine = F.ltrim("value").startswith("{") | (F.trim("value") == "")
    return lines.select(F.when(fine, F.col("value")).otherwise(F.raise_error(broken).cast("string")).alias("value"), app.alias("app"))


def task_metrics(lines: DataFrame) -> DataFrame:
    """One typed row per ended task (columns in ``TASK_COLUMNS``); times in ms,
    ``launch_time`` / ``finish_time`` as UTC ``timestamp_ntz``."""
    app = F.col("app") if "app" in lines.columns else F.lit(None).cast("string")
    ends = lines.where(F.col("value").contains(f'"{TASK_END}"')).select(
        app.alias("app"), F.from_json("value", TASK_END_SCHEMA).alias("e")
    )
    ends = ends.where(F.col("e.Event") == TASK_END)
    info, m, why = F.col("e.`Task Info`"), F.col("e.`Task Metrics`"), F.col("e.`Task End Reason`")
    sr, sw = m.getField("Shuffle Read Metrics"), m.getField("Shuffle Write Metrics")

    launch, finish = info.getField("Launch Time"), info.getField("Finish Time")
    return ends.select(
        "app",
        F.col("e.`Stage ID`").alias("stage_id"),
        F.col("e.`Stage Attempt ID`").alias("stage_attempt"),
        info.getField("Task ID").alias("task_id"),
        info.getField("Attempt").alias("attempt"),
        info.getField("Executor ID").alias("executor_id"),
        info.getField("Host").alias("host"),
        _ms_to_ntz(launch).alias("launch_time"),
        _ms_to_ntz(finish).alias("finish_time"),
        (finish - launch).alias("duration_ms"),
        m.getField("Executor Run Time").alias("run_ms"),
        m.getField("Executor CPU Time").alias("cpu_ns"),
        m.getField("JVM GC Time").alias("gc_ms"),
        m.getField("Memory Bytes Spilled").alias("memory_spilled"),
        m.getField("Disk Bytes Spilled").alias("disk_spilled"),
        m.getField("Peak Execution Memory").alias("peak_memory"),
        m.getField("Input Metrics").getField("Bytes Read").alias("input_bytes"),
        sr.getField("Fetch Wait Time").alias("fetch_wait_ms"),
        sr.getField("Remote Bytes Read").alias("remote_bytes_read"),
        sr.getField("Local Bytes Read").alias("local_bytes_read"),
        sr.getField("Total Records Read").alias("records_read"),
        sw.getField("Shuffle Bytes Written").alias("shuffle_bytes_written"),
        why.getField("Reason").alias("reason"),
        why.getField("Class Name").alias("error_class"),
        F.coalesce(info.getField("Failed"), F.lit(False)).alias("failed"),
    )


def _ms_to_ntz(c):
    """Epoch milliseconds as a UTC wall-clock ``timestamp_ntz`` (session zone free)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_millis(c).cast("timestamp_ntz"))


def read_task_metrics(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``task_metrics`` straight from log paths (files, rolling folders or globs)."""
    return task_metrics(read_log_lines(spark, paths))
