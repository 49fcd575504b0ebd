"""CSV records that span lines, read in parallel.

A line break within quotes belongs to the record, so whether a line starts a record depends
on all lines before it.  No task reads a whole file for that: a line is a function on two
states, outside and inside quotes, and functions combine by composition.

1. Every split of a file is scanned line by line and gives one row: the state it leads to
   from outside and from inside, and what first decides a quote that was open at its start.
2. Windows over a file's splits compose these: the state each split starts in, the split
   in which a record open there began, and whether its quote will be closed.
3. Every split is scanned again from its known state and gives whole records; parts of a
   record that crosses splits are joined by the split it began in.

A quote that is never closed costs its own line.  Read from inside, a quote closes the field
if a separator or the line's end follows; a quote that follows a separator or the line's
start and doesn't close contradicts the open one: the record before it was broken.  A broken
record's lines are records of their own (the first has an odd number of quotes, so
``tag_csv`` quarantines it), and the contradicting line is read from outside.  Once a
record has closed a quote on a further line, its lines up to there stay together even if it
breaks later.

What can't be told apart: a line within quotes that itself opens a quote like a record, and
a broken record followed by a line whose first quote ends a field.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablelab.session import scratch_dir

OUTSIDE, INSIDE = 0, 1
#: What a line says of a quote open at its start: nothing, it closes, it was never meant to.
NOTHING, CLOSES, CONTRADICTS = 0, 1, 2
#: Rows of the table of splits that is broadcast, each some 40 bytes: 160 MB at most, for 512 TB in splits of 128 MB.
MAX_SPLITS = 4_000_000


def scan(line: str, state: int, sep: str = ",", quote: str = '"', escape: str = "\\") -> tuple[int, int]:
    """(state at the end of ``line``, what decided a quote open at its start)."""
    size = len(line) - line.endswith("\r")
    at, event, began = 0, NOTHING, state
    while True:
        if state == OUTSIDE:
            if line.startswith(quote, at) and at < size:
                state, at = INSIDE, at + len(quote)
                continue
            found = line.find(sep, at)
            if found < 0:
                return OUTSIDE, event
            at = found + len(sep)
            continue
        found = line.find(quote, at)
        if found < 0:
            return INSIDE, event
        after = found + len(quote)
        if escape != quote and found - len(line[:found].rstrip(escape)) & 1 and found > at:
            at = after  # an escaped quote
        elif line.startswith(quote, after):
            at = after + len(quote)  # a doubled quote
        elif after == size or line.startswith(sep, after):
            event = event or CLOSES
            if after == size:
                return OUTSIDE, event
            state, at = OUTSIDE, after + len(sep)
        elif began == INSIDE and not event and (found == 0 or line.endswith(sep, 0, found)):
            return INSIDE, CONTRADICTS
        else:
            at = after  # a quote within a field


class Line:
    """A line that holds a quote, as a function on the two states."""

    __slots__ = ("end", "event")

    def __init__(self, text: str, options: tuple[str, str, str]):
        outside, _ = scan(text, OUTSIDE, *options)
        inside, self.event = scan(text, INSIDE, *options)
        self.end = (outside, outside if self.event == CONTRADICTS else inside)


class Split:
    """The composition of the lines of a split so far."""

    def __init__(self):
        self.end, self.event, self.anew = (OUTSIDE, INSIDE), NOTHING, False

    def add(self, line: Line) -> None:
        # Whether, read from inside, a record has begun in this split.
        if self.end[INSIDE] == INSIDE:
            self.anew |= line.event == CONTRADICTS or line.end[INSIDE] == OUTSIDE
        self.event = self.event or line.event
        self.end = (line.end[self.end[OUTSIDE]], line.end[self.end[INSIDE]])


def _stretches(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, from, to) of each run of equal keys."""
    edges = np.flatnonzero(np.diff(keys)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
        if b > a:
            yield int(keys[a]), a, b


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines in the order of their files: value, file, start of the split, and a key of both."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    place = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return place.withColumn("split", F.xxhash64("file", "start"))


def _compose(lines: DataFrame, options: tuple[str, str, str]) -> DataFrame:
    """A row per split: split, file, start, outside, inside, event, anew."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, where, so_far = None, None, Split()
        row = lambda: pa.RecordBatch.from_pylist([dict(
            split=now, file=where[0], start=where[1], outside=so_far.end[0], inside=so_far.end[1], event=so_far.event, anew=so_far.anew,
        )], schema=pa.schema([("split", pa.int64()), ("file", pa.string()), ("start", pa.int64()), ("outside", pa.int32()),
                              ("inside", pa.int32()), ("event", pa.int32()), ("anew", pa.bool_())]))
        for batch in batches:
            value = batch.column("value")
            quoted = pc.match_substring(value, options[1])
            for key, a, b in _stretches(batch.column("split").to_numpy()):
                if key != now:
                    if now is not None:
                        yield row()
                    now, where, so_far = key, (batch.column("file")[a].as_py(), batch.column("start")[a].as_py()), Split()
                for text in value.slice(a, b - a).filter(quoted.slice(a, b - a)).to_pylist():
                    so_far.add(Line(text, options))
        if now is not None:
            yield row()

    return lines.mapInArrow(compose, "split long, file string, start long, outside int, inside int, event int, anew boolean")


def _placed(splits: DataFrame) -> DataFrame:
    """A row per split: the state it starts in, what closes quotes open at its start and end, and where a record open at its start began."""
    w = Window.partitionBy("file").orderBy("start")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    onward = w.rowsBetween(0, Window.unboundedFollowing)
    swaps = F.col("outside") > F.col("inside")
    counted = splits.withColumn("swaps", F.sum(swaps.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # The last split that leads to one state from both, and the swaps since.
    settled = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "swaps"))
    known = counted.withColumn("last", F.last(settled, True).over(before)).withColumn("upto", F.coalesce(F.last("swaps").over(before), F.lit(0)))
    state = F.pmod(F.coalesce("last.outside", F.lit(OUTSIDE)) + F.col("upto") - F.coalesce("last.swaps", F.lit(0)), F.lit(2))
    told = F.when(F.col("event") != NOTHING, F.col("event"))
    started = known.withColumn("state", state.cast("int")).withColumns({
        "at_start": F.coalesce(F.first(told, True).over(onward), F.lit(NOTHING)),
        "at_end": F.coalesce(F.first(told, True).over(after), F.lit(NOTHING)),
    })
    end = F.when(F.col("state") == OUTSIDE, F.col("outside")).otherwise(F.col("inside"))
    begins = (end == INSIDE) & ((F.col("state") == OUTSIDE) | F.col("anew"))
    return started.withColumn("opener", F.last(F.when(begins, F.col("split")), True).over(before)).select(
        "split", "state", F.col("at_start").alias("closes_start"), F.col("at_end").alias("closes_end"), "opener", (end == INSIDE).alias("open")
    )


class _Records:
    """The records of one split, line after line."""

    def __init__(self, split: int, state: int, closes_start: int, closes_end: int, opener: int | None):
        self.split, self.closes_end, self.opener = split, closes_end == CLOSES, opener
        self.state, self.held, self.kept = state, [], 0
        # Lines of a record that an earlier split began, or of one that turned out broken.
        self.head = state == INSIDE and closes_start == CLOSES
        self.loose = state == INSIDE and not self.head
        self.out: list[tuple[str, int | None]] = []

    def _flush(self, keep: int) -> None:
        """The first ``keep`` lines held are a record, or part of one; the others each are one."""
        if keep:
            self.out.append(("\n".join(self.held[:keep]), self.opener if self.head else None))
        self.out += [(x, None) for x in self.held[keep:]]
        self.held, self.kept, self.head, self.loose = [], 0, False, False

    def add(self, text: str, line: Line | None) -> None:
        if self.state == INSIDE:
            event = line.event if line else NOTHING
            if event == CONTRADICTS:
                self._flush(self.kept)
                self.state = OUTSIDE
            elif self.loose:
                self.out.append((text, None))
                return
            else:
                self.held.append(text)
                if event == CLOSES:
                    self.kept = len(self.held)
                self.state = line.end[INSIDE] if line else INSIDE
                if self.state == OUTSIDE:
                    self._flush(len(self.held))
                return
        if line and line.end[OUTSIDE] == INSIDE:
            self.state, self.held = INSIDE, [text]
        else:
            self.out.append((text, None))

    def end(self) -> None:
        if self.held and self.closes_end:
            self.out.append(("\n".join(self.held), self.opener if self.head else self.split))
        elif self.held:
            self._flush(self.kept)


def _records(lines: DataFrame, options: tuple[str, str, str]) -> DataFrame:
    """Lines with their split's place to records: value, file, and for parts of a record the split it began in."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Records | None = None
        place = None

        def drained() -> pa.RecordBatch:
            out, now.out = now.out, []
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.string()), pa.array([place[0]] * len(out), pa.string()),
                 pa.array([place[1]] * len(out), pa.int64()), pa.array([k for _, k in out], pa.int64())],
                names=["value", "file", "start", "part_of"],
            )

        for batch in batches:
            value = batch.column("value")
            quoted = pc.match_substring(value, options[1]).to_numpy(zero_copy_only=False)
            states = batch.column("state")
            for key, a, b in _stretches(batch.column("split").to_numpy()):
                if now is None or key != now.split:
                    if now is not None:
                        now.end()
                        yield drained()
                    if not states[a].is_valid:
                        raise RuntimeError("the files or their splits changed between two scans; read them again")
                    told = [batch.column(c)[a].as_py() for c in ("state", "closes_start", "closes_end", "opener")]
                    now, place = _Records(key, *told), (batch.column("file")[a].as_py(), batch.column("start")[a].as_py())
                for text, q in zip(value.slice(a, b - a).to_pylist(), quoted[a:b], strict=True):
                    now.add(text, Line(text, options) if q else None)
                yield drained()
        if now is not None:
            now.end()
            yield drained()

    return lines.mapInArrow(records, "value string, file string, start long, part_of long")


def read_csv_records(spark: SparkSession, path: str, sep: str = ",", quote: str = '"', escape: str = "\\") -> DataFrame:
    """``(value, source)``: each CSV record below ``path`` as text, line breaks included, with its file.

    For :func:`tablelab.operators.quality.tag_csv` and its relatives.  Lines end in LF or
    CR LF (a final CR is taken off a record).  Files may be split anywhere; those compressed
    as a whole are one split.  The table of splits, a few dozen bytes for each, is broadcast, and
    refused beyond ``MAX_SPLITS``.  A split's lines are read in order within one task; a record
    is held in memory, and so are a split's lines after a quote that nothing closes there.
    Files must not change between the scans; if their splits do, the read fails.
    """
    options = (sep, quote, escape)
    lines = _lines(spark, path)
    folder = scratch_dir(spark, "csv-splits")
    _compose(lines, options).write.parquet(folder)
    found = spark.read.parquet(folder)
    if found.count() > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits: raise spark.sql.files.maxPartitionBytes")
    placed_at = scratch_dir(spark, "csv-places")
    _placed(found).write.parquet(placed_at)
    placed = spark.read.parquet(placed_at)
    # The broadcast side is one row per split, checked above; a broadcast keeps the lines' order.
    every = lines.join(F.broadcast(placed.drop("open")), "split", "left")
    whole = _records(every, options).where("part_of is null").select("value", "file")
    # Parts of records that cross splits: only splits that have some are scanned by Python.
    crossing = placed.where(f"(state = {INSIDE} and closes_start = {CLOSES}) or (open and closes_end = {CLOSES})").drop("open")
    parts = _records(lines.join(F.broadcast(crossing), "split"), options).where("part_of is not null")
    joined = parts.groupBy("file", "part_of").agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("p"))
    crossed = joined.select(F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"), "file")
    records = whole.unionByName(crossed)
    return records.select(F.regexp_replace("value", r"\r\z", "").alias("value"), F.col("file").alias("source"))
