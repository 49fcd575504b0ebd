"""What a stream has not emitted yet, read from its checkpoint.

Append mode emits a window or session once the watermark has passed it.  The rest stands in the
state store, a table per stateful operator that Spark's ``statestore`` source reads, of the
last micro-batch or an earlier one, while the stream rests.  Emitted rows and open ones are
together what a batch over the same input gives.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.functions import instant_to_ntz
from tablelab.streaming.windows import _names


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """``key, value, partition_id`` of one stateful operator, after micro-batch ``batch`` or the last one.

    The state is read by partitions in parallel, as it was written; nothing of the stream
    needs to run, and nothing is changed."""
    r = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        r = r.option("batchId", batch)
    return r.load(checkpoint)


def open_windows(
    spark: SparkSession, checkpoint: str, aggs: Mapping[str, Column], keys: str | Sequence[str] = (), batch: int | None = None
) -> DataFrame:
    """The windows that a ``windows.windowed`` stream still holds, in the columns it emits.

    ``aggs``: each aggregate by name, from its buffer in ``value`` (``value.count``; ``value.sum``
    of a decimal sum; see the schema of ``read_state``)."""
    state = read_state(spark, checkpoint, 0, batch)
    start, end = (instant_to_ntz(F.col(f"key.window.{x}")) for x in ("start", "end"))
    return state.select(
        start.alias("window_start"), end.alias("window_end"), *[F.col(f"key.`{k}`").alias(k) for k in _names(keys)],
        *[c.alias(name) for name, c in aggs.items()],
    )


def open_sessions(
    spark: SparkSession, checkpoint: str, keys: str | Sequence[str], aggs: Mapping[str, Column], batch: int | None = None
) -> DataFrame:
    """The sessions that a ``windows.sessions`` stream still holds, in the columns it emits."""
    state = read_state(spark, checkpoint, 0, batch)
    start, end = (instant_to_ntz(F.col(f"value.session_window.{x}")) for x in ("start", "end"))
    return state.select(
        *[F.col(f"value.`{k}`").alias(k) for k in _names(keys)], start.alias("session_start"), end.alias("session_end"),
        *[c.alias(name) for name, c in aggs.items()],
    )
