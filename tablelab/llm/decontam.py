"""Benchmark decontamination by a prefix-filtered containment join.

A window is what a document must not hold: ``window`` consecutive words of a benchmark
item, or a whole shorter item.  A window's set is its word shingles; a document that
holds the window holds all of them, so the necessary prefix is a single shingle.

1. The rarity of each benchmark shingle is counted over all documents.
2. Each window is indexed under its rarest shingle, its anchor, with the place it has.
3. Documents probe with all their shingles; a place is a candidate if the window, put
   there by its anchor, lies within the document (the positional and length bounds).
4. Candidates are verified word by word on the words around the anchor.

Documents are scanned twice and never shuffled.  A bit filter of fixed size, broadcast
with a known bound, holds back shingles that are in no window; what passes it is joined
exactly, so a larger benchmark costs rows, not memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.llm import packed
from tablelab.llm.common import ALNUM_LOWER, col, fresh, settled
from tablelab.session import scratch_dir

WINDOW = 13
SHINGLE = 5
#: The share of its words from which a document is contaminated, as one in so many.
ONE_IN = 20
#: The filter is 2 ** FILTER_BITS bits (2 MB).
FILTER_BITS = 24
#: Text held as words at a time.
SLICE_BYTES = 2 << 20
_BLOCK = 1 << 16  # bytes of the filter that one task builds


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(ALNUM_LOWER).split()


def _shingles(texts: packed.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, at = texts.windows(size)
    return packed.mix64(hashes ^ np.uint64(size)), at


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds a few megabytes of text, or one longer text."""
    for batch in batches:
        size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(size):
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE_BYTES, side="right")))
            yield batch.slice(at, end - at)
            at = end


def item_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
                 shingle: int = SHINGLE) -> DataFrame:
    """``(window, item, words, shingles)`` of a benchmark: a row per item and window.

    ``window`` numbers the words by 64 bits; ``shingles`` are (hash, offset).  Null and
    wordless items have none; shorter items are one window.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"], strict=True):
                words = words_of(text)
                for a in range(max(1, len(words) - window + 1) if words else 0):
                    own = words[a : a + window]
                    texts = packed.Texts(pa.chunked_array([[0]]), [own])
                    size = min(shingle, len(own))
                    hashes, at = _shingles(texts, size)
                    number = int(packed.rolling(texts.hashes, len(own))[0].view(np.int64))
                    found = [{"hash": int(h), "at": int(i)} for h, i in zip(hashes.view(np.int64), at, strict=True)]
                    rows.append((number, item, [w.decode("utf-8", "surrogatepass") for w in own], size, found))
            yield pd.DataFrame(rows, columns=["window", "item", "words", "size", "shingles"])

    return benchmark.select(col(item_col).cast("string").alias("item"), col(text_col).alias("text")).mapInPandas(
        cut, "window long, item string, words array<string>, size int, shingles array<struct<hash: long, at: int>>"
    )


def bit_filter(hashes: DataFrame) -> bytes:
    """A filter of ``2 ** FILTER_BITS`` bits of the hashes in the first column.

    Tasks build blocks of it; what reaches the driver and is broadcast has a fixed size.
    """

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(_BLOCK * 8, bool)
        bits[frame["bit"].to_numpy() % (_BLOCK * 8)] = True
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "bits": [np.packbits(bits).tobytes()]})

    name = hashes.columns[0]
    bit = F.shiftrightunsigned(F.col(name), 64 - FILTER_BITS)
    blocks = (
        hashes.select(bit.alias("bit")).distinct().withColumn("block", F.floor(F.col("bit") / (_BLOCK * 8)))
        .groupBy("block").applyInPandas(build, "block long, bits binary")
    )
    out = bytearray((1 << FILTER_BITS) // 8)
    for row in blocks.collect():  # at most 32 blocks
        out[row["block"] * _BLOCK : (row["block"] + 1) * _BLOCK] = row["bits"]
    return bytes(out)


def _passing(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - FILTER_BITS)
    return np.flatnonzero(bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1)


def rarity(docs: DataFrame, text_col: str, known: DataFrame, sizes: list[int]) -> DataFrame:
    """``(hash, n)``: in how many documents each known shingle is; those in none are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(known.select("hash")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for part in slices(batches, "text"):
            texts = packed.Texts(pa.chunked_array([pa.nulls(len(part), pa.int64())]), map(words_of, part.column("text").to_pylist()))
            pairs = []
            for size in sizes:
                hashes, at = _shingles(texts, size)
                hit = _passing(hashes, bits)
                pairs.append(np.unique(np.stack([hashes[hit], texts.doc[at[hit]].astype(np.uint64)]), axis=1)[0])
            found, n = np.unique(np.concatenate(pairs), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["hash", "n"])

    met = docs.select(col(text_col).alias("text")).mapInArrow(count, "hash long, n long")
    return met.groupBy("hash").agg(F.sum("n").alias("n")).join(known.select("hash").distinct(), "hash", "left_semi")


def anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``(window, words, hash, at)``: each window under its rarest shingle; one that isn't in any document goes."""
    each = windows.dropDuplicates(["window"]).select("window", "words", F.explode("shingles").alias("s"))
    ranked = each.join(counts, each["s.hash"] == counts["hash"], "left")
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("s.hash").alias("hash"), F.col("s.at").alias("at"))).alias("best")
    return (
        ranked.groupBy("window").agg(best, F.first("words").alias("words"))
        .where("best.n > 0").select("window", "words", "best.hash", "best.at")
    )


def _hits(texts: packed.Texts, bits: np.ndarray, sizes: list[int], reach: int) -> pa.ListArray:
    """Per text the places of shingles that pass the filter, with the words around them.

    Built by columns, as where every word is a hit the words are there ``2 * reach`` times.
    """
    found = []
    for size in sizes:
        hashes, at = _shingles(texts, size)
        hit = _passing(hashes, bits)
        found.append((hashes[hit].view(np.int64), at[hit], np.full(len(hit), size)))
    hashes, at, size = map(np.concatenate, zip(*found, strict=True))
    order = np.argsort(texts.doc[at], kind="stable")
    hashes, at, size = hashes[order], at[order], size[order]
    doc = texts.doc[at]
    first = np.maximum(texts.starts[doc], at + size - reach)
    ends = np.concatenate([[0], np.cumsum(np.minimum(texts.ends[doc], at + reach) - first)]).astype(np.int64)
    place = np.arange(ends[-1], dtype=np.int32) + np.repeat((first - ends[:-1]).astype(np.int32), np.diff(ends))
    words = pa.array(chain.from_iterable(texts.words) if len(at) else [], pa.binary()).cast(pa.string())
    around = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(place)))
    columns = [pa.array(hashes), pa.array(at - texts.starts[doc]), pa.array(first - texts.starts[doc]), around]
    each = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts.words)))])
    return pa.ListArray.from_arrays(pa.array(each, pa.int32()), pa.StructArray.from_arrays(columns, ["hash", "pos", "from", "around"]))


def probe(docs: DataFrame, index: DataFrame, sizes: list[int], reach: int) -> DataFrame:
    """``(id, key, text)`` to ``(id, key, n_words, hits)``: places of possible anchors with the words around them.

    Row by row; ``hits`` has (hash, pos, from, around): the words from ``from`` on, as far as a
    window with this anchor could reach.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(index.select("hash")))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for part in slices(batches, "text"):
            texts = packed.Texts(pa.chunked_array([pa.nulls(len(part), pa.int64())]), map(words_of, part.column("text").to_pylist()))
            hits = _hits(texts, bits, sizes, reach)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.array(texts.lengths), hits], ["id", "key", "n_words", "hits"])

    id_type = dict(docs.dtypes)["id"]
    return docs.select("id", "key", "text").mapInArrow(
        look, f"id {id_type}, key long, n_words long, hits array<struct<hash: long, pos: long, `from`: long, around: array<string>>>"
    )


def covered(spans: Column) -> Column:
    """How many words the spans (start, end) cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    step = lambda a, s: F.struct(
        (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], s["end"]).alias("to")
    )
    return F.aggregate(F.array_sort(spans), start, step, lambda a: a["n"])


def find_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """``(id, key, n_words, n_hit, items, spans)`` per row of ``docs``.

    ``key`` is xxhash64 of the text: with the id it names a row; repeated rows are alike.
    ``items``: ids, as strings, of items that have a window in the document, sorted;
    ``spans``: (start, end) of the windows found.  A null id is a value like others; a
    null text has no words; an empty benchmark finds nothing.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "windows")
    item_windows(benchmark, item_col, item_text_col, window, shingle).write.parquet(path)
    windows = spark.read.parquet(path)
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most `shingle` numbers
    texts = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("key"), col(text_col).alias("text"))
    known = windows.select(F.explode("shingles.hash").alias("hash")).distinct()
    path = scratch_dir(spark, "anchors")
    anchors(windows, rarity(docs, text_col, known, sizes or [shingle])).write.parquet(path)
    index = spark.read.parquet(path)
    path = scratch_dir(spark, "probes")
    probe(texts, index, sizes or [shingle], window).write.parquet(path)
    probed = spark.read.parquet(path)
    hit = probed.where(F.size("hits") > 0).select("id", "key", "n_words", F.explode("hits").alias("h")).select(
        "id", "key", "n_words", "h.hash", "h.pos", "h.from", "h.around"
    )
    size = F.size("words")
    start = F.col("pos") - F.col("at")
    found = hit.join(index, "hash").where((start >= 0) & (start + size <= F.col("n_words")) & (start >= F.col("from")))
    found = found.where(F.slice("around", (start - F.col("from") + 1).cast("int"), size) == F.col("words"))
    # One row for a window in a document, then one for each item that has the window.
    spans = found.groupBy("id", "key", "window").agg(F.collect_set(F.struct(start.alias("start"), (start + size).alias("end"))).alias("spans"))
    per_doc = spans.groupBy("id", "key").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.collect_list("window").alias("windows")
    )
    named = spans.select("id", "key", "window").join(windows.select("window", "item").distinct(), "window")
    items = named.groupBy("id", "key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    facts = per_doc.join(items.withColumnsRenamed({"id": "id2", "key": "key2"}), F.col("id").eqNullSafe(F.col("id2")) & (F.col("key") == F.col("key2")))
    facts = facts.select(F.col("id").alias("id3"), F.col("key").alias("key3"), "spans", "items")
    joined = probed.select("id", "key", "n_words").join(
        facts, F.col("id").eqNullSafe(F.col("id3")) & (F.col("key") == F.col("key3")), "left"
    )
    return joined.select(
        "id", "key", "n_words", F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>")).alias("spans"),
    )


def is_contaminated(n_hit: Column, n_words: Column, one_in: int = ONE_IN) -> Column:
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged."""
    a, b = fresh(docs, "_id", "_key")
    found = find_items(docs, benchmark, id_col, text_col, **kwargs).where(is_contaminated(F.col("n_hit"), F.col("n_words")))
    gone = settled(found.select(F.col("id").alias(a), F.col("key").alias(b)).distinct(), "contaminated")
    return docs.join(gone, col(id_col).eqNullSafe(F.col(a)) & (F.xxhash64(col(text_col)) == F.col(b)), "left_anti")
