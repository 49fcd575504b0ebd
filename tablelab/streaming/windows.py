"""Event-time operators that run unchanged on batch and streaming DataFrames.

Event time arrives as ``timestamp_ntz`` (UTC wall clock).  Watermarks need
``timestamp``, so the operators convert through UTC and return window bounds as
``timestamp_ntz`` again; results do not depend on the session time zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.functions import instant_to_ntz, ntz_to_instant

EVENT_TIME = "__event_time"
#: Rows of a task become sessions before the shuffle of a stream.
SESSION_CONF = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def _names(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def with_event_time(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    """Add the ``timestamp`` event-time column, with a watermark on streams."""
    out = df.withColumn(EVENT_TIME, ntz_to_instant(ts))
    if delay is not None and df.isStreaming:
        out = out.withWatermark(EVENT_TIME, delay)
    return out


def windowed(
    df: DataFrame,
    ts: str,
    size: str,
    aggs: Sequence[Column],
    slide: str | None = None,
    delay: str | None = "1 hour",
    keys: str | Sequence[str] | None = None,
) -> DataFrame:
    """Tumbling (``slide=None``) or sliding windows of ``size``: window_start,
    window_end, keys, aggregates.  On a stream, append mode emits a window once the
    watermark (max event time - ``delay``) passes its end; rows arriving for a window
    already closed are dropped."""
    keys = _names(keys)
    ev = with_event_time(df, ts, delay)
    w = F.window(EVENT_TIME, size, slide) if slide else F.window(EVENT_TIME, size)
    out = ev.groupBy(w.alias("w"), *keys).agg(*aggs)
    rest = [c for c in out.columns if c != "w"]
    return out.select(
        instant_to_ntz(F.col("w.start")).alias("window_start"), instant_to_ntz(F.col("w.end")).alias("window_end"), *rest
    )


def sessions(
    df: DataFrame,
    keys: str | Sequence[str],
    ts: str,
    gap: str,
    aggs: Sequence[Column],
    delay: str | None = "1 hour",
) -> DataFrame:
    """Session windows per key: a gap longer than ``gap`` starts a new session (an
    event exactly ``gap`` after the previous one still joins it).
    Returns keys, session_start, session_end (last event + gap), aggregates.

    A batch merges a task's rows into sessions before the shuffle, so a hot key sends a
    row per session and task.  A stream does so where its session has ``SESSION_CONF``
    (``runner.stream_session(spark, **SESSION_CONF)``); no setting is made here."""
    keys = _names(keys)
    ev = with_event_time(df, ts, delay)
    out = ev.groupBy(F.session_window(EVENT_TIME, gap).alias("s"), *keys).agg(*aggs)
    rest = [c for c in out.columns if c != "s"]
    return out.select(
        *keys,
        instant_to_ntz(F.col("s.start")).alias("session_start"),
        instant_to_ntz(F.col("s.end")).alias("session_end"),
        *[c for c in rest if c not in keys],
    )


def dedup(df: DataFrame, keys: str | Sequence[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Drop repeated ``keys``.  On a stream: ``dropDuplicatesWithinWatermark`` keeps
    state only for ``delay`` past each key's first event time, so state stays bounded;
    on a batch it is ``dropDuplicates``.  The helper event-time column is removed."""
    keys = _names(keys)
    if df.isStreaming:
        ev = with_event_time(df, ts, delay)
        return ev.dropDuplicatesWithinWatermark(keys).drop(EVENT_TIME)
    return df.dropDuplicates(keys)


def late_report(spark, progress: Sequence[dict]) -> DataFrame:
    """What a finished stream did with late rows, from its own progress: batch, rows,
    late_rows, watermark (event time, UTC) of each micro-batch that had input.

    ``late_rows`` is what the engine dropped for being older than the watermark.  It counts
    rows for operators that see rows (``dedup``, joins), groups for aggregates."""
    rows = [
        (
            int(p["batchId"]), int(p["numInputRows"]), sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in p["stateOperators"]),
            p.get("eventTime", {}).get("watermark"),
        )
        for p in progress
    ]
    made = spark.createDataFrame(rows, "batch long, rows long, late_rows long, watermark string")
    return made.withColumn("watermark", instant_to_ntz(F.to_timestamp("watermark")))
