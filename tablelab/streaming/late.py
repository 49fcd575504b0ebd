"""Late rows kept instead of dropped: every row of a stream goes on, told apart.

Built-in stateful operators drop rows older than the watermark.  Here the rows pass through
``transformWithState`` keyed by the caller's keys; the event-time column with the watermark is
left out before it, so the engine knows the watermark and drops nothing.  Each key's
state is its latest event time; an event-time timer forgets keys that have been idle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tablelab.functions import col_of, instant_to_ntz
from tablelab.streaming.windows import EVENT_TIME, _names, with_event_time

#: Settings a session needs for these operators; see ``runner.stream_session``.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}
#: Stands for a null event time where pandas would turn whole numbers into floats.
_NONE = -(1 << 62)


class _TellLate(StatefulProcessor):
    def __init__(self, idle_us: int):
        self.idle_us = idle_us

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000 or _NONE
        known = self.latest.get()
        before = most = known[0] if known else _NONE
        for pdf in rows:
            most = max(most, int(pdf["us"].max()))
            late = (pdf["us"] <= watermark) & (pdf["us"] != _NONE)
            yield pdf.filter(regex="^c").assign(late=late, watermark=watermark, latest=before)
        if most > before:
            self.latest.update((most,))
        if before == _NONE and most > before:
            self._wake(most)

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(max(1, (us + self.idle_us) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # One timer a key: set at its first row, and again from its latest row when it goes off.
        latest = self.latest.get()[0]
        if (latest + self.idle_us) // 1000 <= timerValues.getCurrentWatermarkInMs():
            self.latest.clear()
        else:
            self._wake(latest)
        return iter(())

    def close(self) -> None:
        pass


def mark_late(stream: DataFrame, keys: str | Sequence[str], ts: str, delay: str, idle: str = "30 days") -> DataFrame:
    """All rows of a stream with ``late``, ``watermark`` and ``latest``.

    ``late``: the event time was at or before the watermark when the row's micro-batch
    began (``watermark``, null before there is one).  ``latest``: the key's latest event time in
    the micro-batches before, null if there was none or the key was forgotten, which it is
    when the watermark passes ``idle`` after that time.

    A row with a null event time is not late and leaves the state alone; null keys are a
    key.  Repeated rows stay repeated.  Rows of a key in a micro-batch pass through one task
    in Arrow batches; name a column that splits a hot key among ``keys`` to spread it, and
    ``latest`` is then of the finer key.  The session needs ``STATE_CONF``.
    """
    if not stream.isStreaming:
        raise ValueError("a batch has no watermark: every row would be on time")
    clash = {"late", "watermark", "latest"} & {c.lower() for c in stream.columns}
    if clash:
        raise ValueError(f"rename these columns: {sorted(clash)}")
    keys = _names(keys)
    ev = with_event_time(stream, ts, delay)
    # Whole numbers beyond 2^53 and nulls don't mix in pandas: long columns travel as text.
    # Any name may stand in the caller's schema: columns travel under plain names.
    fields = stream.schema.fields
    wide = {f"c{k}" for k, f in enumerate(fields) if isinstance(f.dataType, T.LongType)}
    carried = [col_of(f.name).cast("string" if f"c{k}" in wide else f.dataType).alias(f"c{k}") for k, f in enumerate(fields)]
    named = [col_of(k).cast("string").alias(f"key{n}") for n, k in enumerate(keys)]
    rows = ev.select(*carried, *named, F.coalesce(F.unix_micros(EVENT_TIME), F.lit(_NONE)).alias("us"))
    out = T.StructType([T.StructField(f"c{k}", T.StringType() if f"c{k}" in wide else f.dataType) for k, f in enumerate(fields)])
    out = out.add("late", "boolean").add("watermark", "long").add("latest", "long")
    grouped = rows.groupBy(*[f"key{n}" for n in range(len(keys))])
    told = grouped.transformWithStateInPandas(_TellLate(_micros(stream, idle)), out, "Append", "EventTime")
    back = [F.col(f"c{k}").cast(f.dataType).alias(f.name) for k, f in enumerate(fields)]
    instant = lambda c: instant_to_ntz(F.timestamp_micros(F.when(F.col(c) != _NONE, F.col(c)))).alias(c)
    return told.select(*back, "late", instant("watermark"), instant("latest"))


def _micros(stream: DataFrame, span: str) -> int:
    """The length of a span such as ``30 days``."""
    zero = F.timestamp_micros(F.lit(0))
    return stream.sparkSession.range(1).select(F.unix_micros(zero + F.expr(f"interval {span}"))).first()[0]
