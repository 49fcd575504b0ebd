"""Running streams to completion and resuming them.

``run_available`` processes everything available (trigger ``availableNow``) and
writes each micro-batch to ``<sink>/tablelab_batch=<id>`` with overwrite.  A micro-batch
replayed after a failure rewrites its own folder, so the sink never holds a batch
twice; the checkpoint makes a second run continue where the first stopped.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.operators.quality import split as split_tagged
from tablelab.operators.quality import tag_json


#: The folder level of a sink; no column of the stream may have this name.
BATCH = "tablelab_batch"
#: The state's size is read from the session when a query starts; starts take turns.
_STARTING = threading.Lock()


def stream_session(spark: SparkSession, state_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session of its own for a stream, with the caller's settings and these.

    Settings that a stream's start reads (how many partitions its state has, where it is
    kept) are made here, so the caller's session stays as it is."""
    own = spark.newSession()
    for k, v in dict(spark.conf.getAll).items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    for k, v in conf.items():
        own.conf.set(k, v)
    return own


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A file-source stream with an explicit schema (no inference)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _batch_writer(sink: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch_id}")

    return write


def run_available(
    df: DataFrame,
    sink: str,
    checkpoint: str,
    output_mode: str = "append",
    on_batch: Callable[[DataFrame, int], None] | None = None,
    state_partitions: int | None = None,
) -> list[dict]:
    """Run ``df`` over all available input, then stop (``availableNow``).  Returns the
    progress of each micro-batch that had input, as the engine reports it.  The engine keeps
    only the last ones (``spark.sql.streaming.numRecentProgressUpdates``), so each is taken
    as the next micro-batch begins.

    ``state_partitions`` sizes the state of stateful operators (it is fixed in the
    checkpoint at the first run; later runs keep it).  Size it to the state, not to
    the batch: every micro-batch visits every state partition.  It is set in the stream's
    session while the query starts; a stream of ``stream_session`` has it from the outset.
    """
    if BATCH in df.columns:
        raise ValueError(f"the sink's folders are named after {BATCH}; rename that column")
    spark = df.sparkSession
    key = "spark.sql.shuffle.partitions"
    write, progress = on_batch or _batch_writer(sink), {}
    query, started = [], threading.Event()

    def note(p) -> None:
        progress[p.batchId, p.timestamp] = p

    def each(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        if query and (last := query[0].lastProgress):
            note(last)
        write(batch, batch_id)

    with _STARTING:
        previous = spark.conf.get(key)
        if state_partitions:
            spark.conf.set(key, str(state_partitions))
        try:
            q = (
                df.writeStream.outputMode(output_mode)
                .foreachBatch(each)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
            )
            query.append(q)
        finally:
            started.set()
            spark.conf.set(key, previous)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced by awaitTermination already
        raise RuntimeError(str(q.exception()))
    for p in q.recentProgress:
        note(p)
    return [json.loads(p.json) for _, p in sorted(progress.items()) if p.numInputRows > 0]


def read_sink(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches written by :func:`run_available` (without the folder level)."""
    r = spark.read
    if schema is not None:
        r = r.schema(T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())]))
    return r.parquet(sink).drop(BATCH)


def bus_shape(lines: DataFrame, topic: str = "events") -> DataFrame:
    """A text stream in the shape a message bus delivers: key, value, topic,
    partition, offset, timestamp (value is the payload)."""
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def quarantine_stream(
    stream: DataFrame, schema, good_sink: str, bad_sink: str, checkpoint: str, source_col: str = "topic"
) -> None:
    """Parse a bus-shaped JSON stream into good and bad sinks, one folder per batch.

    Parsing is stateless (``from_json``).  Each micro-batch is parsed once, kept
    while its two outputs are written, then released.
    """
    lines = stream.select(F.col("value").cast("string").alias("value"), F.col(source_col).alias("source"))

    def split(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_json(batch, schema).persist()
        try:
            good, bad = split_tagged(tagged, schema, extra=True)
            good.write.mode("overwrite").parquet(f"{good_sink}/{BATCH}={batch_id}")
            bad.write.mode("overwrite").parquet(f"{bad_sink}/{BATCH}={batch_id}")
        finally:
            tagged.unpersist()

    run_available(lines, good_sink, checkpoint, on_batch=split)
