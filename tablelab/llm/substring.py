"""Removal of word sequences that an earlier document already has.

A word goes if a window of ``window`` words that covers it also starts in a document
with a smaller id.  Fixed-block anchors find the windows worth comparing:

1. Non-overlapping blocks of ``block = (window + 1) // 2`` words, from each document's
   start, are the index; every rolling window of ``block`` words probes it.  Any repeat
   of ``window`` words holds a whole block of either document, so each is hit.
2. Hits are extended: the windows around a hit are compared whole, by 64 bits and those
   of their bucket, with the least id that has each.  Adjoining windows that repeat merge
   into maximal exact repeats.

Both comparisons go through packed hash buckets (see ``packed``): a group of documents
sends each distinct hash once, so neither a passage found everywhere nor a large group
of copies makes one bucket or task large, and no pairs are formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tablelab.llm import packed
from tablelab.llm.common import col, fresh

WINDOW = 13
_SENT = "g long, bucket long, kind int, n long, keys binary, extra binary, width int, least long"
_REPLY = "g long, bucket long, kind int, bits binary"
_ANCHOR, _WHOLE = 0, 1


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in (x.split() for x in ddl.split(", "))])
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


class _Group:
    """A group's documents and what has been found out about their windows."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, window: int, bits: int):
        texts = table.column(text_col).to_pylist()
        self.texts = packed.Texts(table.column(id_col), ([] if t is None else t.encode("utf-8", "surrogatepass").split() for t in texts))
        self.window, self.block, self.bits = window, (window + 1) // 2, bits

    def anchors(self):
        """Distinct cut hashes of all block-long windows, sorted; for each window its place among them; where windows start."""
        hashes, at = self.texts.windows(self.block)
        keys, place = np.unique(packed.cut(hashes, self.bits), return_inverse=True)
        return keys, place, at

    def candidates(self, reply: pa.Table):
        """Whole windows around hits: distinct hashes, place of each window, where they start, by bucket order."""
        keys, place, at = self.anchors()
        shared = answers(keys, reply, _ANCHOR, self.bits)
        hit = np.zeros(self.texts.n + 1, np.int64)
        hit[at[shared[place]] + 1] = 1
        hits = np.cumsum(hit)
        hashes, start = self.texts.windows(self.window)
        inside = hits[start + self.window - self.block + 1] > hits[start]
        hashes, start = hashes[inside], start[inside]
        # The bucket comes from other bits than those that are compared.
        named = packed.cut(packed.mix64(hashes ^ packed.GOLDEN), self.bits) >> np.uint64(packed.SENT_BITS)
        order = np.lexsort((hashes, named))
        hashes, start, named = hashes[order], start[order], named[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (named[1:] != named[:-1])
        place = np.cumsum(new) - 1
        return hashes[new], named[new].astype(np.int64), place, start, np.flatnonzero(new)


def answers(keys: np.ndarray, reply: pa.Table, kind: int, bits: int, buckets: np.ndarray | None = None) -> np.ndarray:
    """The bits answered for sorted keys; buckets without an answer have none set."""
    out = np.zeros(len(keys), bool)
    found = {b: d for b, k, d in zip(*(reply.column(c).to_pylist() for c in ("bucket", "kind", "bits")), strict=True) if k == kind}
    if found:
        for bucket, part in packed.split_buckets(keys, bits) if buckets is None else packed.runs(buckets):
            if bucket in found:
                out[part] = packed.unpack_bits(found[bucket], part.stop - part.start)
    return out


def mark_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    words_col: str = "n_words", spans_col: str = "removed", kept_col: str = "kept",
) -> DataFrame:
    """Rows of ``docs`` with the number of words, the removed ranges of words and the rest.

    ``removed``: array of (start, end), words counted from 0, maximal and in order; ``kept``:
    the other words joined by one space.  Ids are whole numbers.  A null text has no words.
    Rows of one id never remove each other's words; a null id counts as larger than any.
    Texts shorter than ``window`` words stay whole.  Clashing column names are
    replaced by the result's.
    """
    docs = docs.drop(words_col, spans_col, kept_col)
    g = fresh(docs, "_group")[0]
    grouped, bits = packed.dealt(docs, id_col, text_col, g)
    block = (window + 1) // 2

    def send_anchors(table: pa.Table) -> pa.Table:
        group = _Group(table, id_col, text_col, window, bits)
        keys, place, at = group.anchors()
        doc, first = group.texts.doc[at], group.texts.starts
        aligned = np.zeros(len(keys), bool)
        aligned[place[(at - first[doc]) % block == 0]] = True
        ids = group.texts.ids[doc]
        low = np.full(len(keys), np.iinfo(np.int64).max)
        high = np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, place, ids)
        np.maximum.at(high, place, ids)
        several = low < high
        rows = []
        number = table.column(g)[0].as_py()
        for bucket, part in packed.split_buckets(keys, bits):
            flags = packed.pack_bits(np.concatenate([aligned[part], several[part]]))
            rows.append((number, bucket, _ANCHOR, part.stop - part.start, packed.pack(keys[part], packed.SENT_BITS // 8), flags, 0, 0))
        return _table(rows, _SENT)

    def shared_anchors(table: pa.Table) -> pa.Table:
        """Of a bucket: which hashes are a block somewhere and occur in two documents or more."""
        n = table.column("n").to_pylist()
        keys = np.concatenate([packed.unpack(x, packed.SENT_BITS // 8) for x in table.column("keys").to_pylist()])
        flags = [packed.unpack_bits(x, 2 * k) for x, k in zip(table.column("extra").to_pylist(), n, strict=True)]
        aligned = np.concatenate([f[:k] for f, k in zip(flags, n, strict=True)])
        several = np.concatenate([f[k:] for f, k in zip(flags, n, strict=True)])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        new = np.flatnonzero(np.diff(ranked, prepend=ranked[0] ^ np.uint64(1)))
        shared = np.logical_or.reduceat(aligned[order], new) & (
            np.logical_or.reduceat(several[order], new) | (np.diff(np.append(new, len(ranked))) > 1)
        )
        out = np.empty(len(keys), bool)
        out[order] = np.repeat(shared, np.diff(np.append(new, len(ranked))))
        return _replies(table, n, out)

    def send_whole(docs_table: pa.Table, reply: pa.Table) -> pa.Table:
        if not len(reply):
            return _table([], _SENT)
        group = _Group(docs_table, id_col, text_col, window, bits)
        keys, buckets, place, start, first = group.candidates(reply)
        least = np.minimum.reduceat(group.texts.ids[group.texts.doc[start]], first) if len(first) else np.empty(0, np.int64)
        number, rows = docs_table.column(g)[0].as_py(), []
        for bucket, part in packed.runs(buckets):
            base = int(least[part].min())
            above = least[part].astype(np.uint64) - np.array(base).astype(np.uint64)
            width = packed.width_of(above)
            rows.append((number, bucket, _WHOLE, part.stop - part.start, packed.pack(keys[part], 8), packed.pack(above, width), width, base))
        # The first answer goes along, so that the last step has both.
        rows += [(number, bucket, _ANCHOR, 0, bits, b"", 0, 0) for bucket, bits in zip(reply.column("bucket").to_pylist(), reply.column("bits").to_pylist(), strict=True)]
        return _table(rows, _SENT)

    def smaller_elsewhere(table: pa.Table) -> pa.Table:
        """Of a bucket: which hashes another group has in a document of a smaller id."""
        whole = pc.equal(table.column("kind"), _WHOLE)
        along = table.filter(pc.invert(whole))
        along = along.select(["g", "bucket", "kind", "keys"]).rename_columns(["g", "bucket", "kind", "bits"])
        table = table.filter(whole)
        if not len(table):
            return along
        n = table.column("n").to_pylist()
        keys = np.concatenate([packed.unpack(x, 8) for x in table.column("keys").to_pylist()])
        least = np.concatenate(
            [
                (packed.unpack(x, w) + np.array(base).astype(np.uint64)).astype(np.int64)
                for x, w, base in zip(*(table.column(c).to_pylist() for c in ("extra", "width", "least")), strict=True)
            ]
        )
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        new = np.flatnonzero(np.diff(ranked, prepend=ranked[0] ^ np.uint64(1)))
        everywhere = np.repeat(np.minimum.reduceat(least[order], new), np.diff(np.append(new, len(ranked))))
        out = np.empty(len(keys), bool)
        out[order] = everywhere < least[order]
        return pa.concat_tables([along, _replies(table, n, out)])

    def finish(docs_table: pa.Table, reply: pa.Table) -> pa.Table:
        group = _Group(docs_table, id_col, text_col, window, bits)
        texts = group.texts
        gone = np.zeros(texts.n, bool)
        if len(reply):
            keys, buckets, place, start, first = group.candidates(reply)
            if len(keys):
                ids = texts.ids[texts.doc[start]]
                earlier = answers(keys, reply, _WHOLE, bits, buckets)[place] | (ids > np.minimum.reduceat(ids, first)[place])
                edge = np.zeros(texts.n + 1, np.int64)
                np.add.at(edge, start[earlier], 1)
                np.add.at(edge, start[earlier] + window, -1)
                gone = np.cumsum(edge)[:-1] > 0
        spans, kept = [], []
        for words, a, b in zip(texts.words, texts.starts, texts.ends, strict=True):
            mask = gone[a:b]
            if mask.any():
                edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                spans.append([{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)])
                words = [w for w, m in zip(words, mask.tolist(), strict=True) if not m]
            else:
                spans.append([])
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        out = docs_table.drop_columns([g])
        pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for name, values in ((words_col, pa.array(texts.lengths)), (spans_col, pa.array(spans, pairs)), (kept_col, pa.array(kept, pa.string()))):
            out = out.append_column(name, values)
        return out

    by_group = lambda df, name=g: df.groupBy(col(name))
    first = by_group(grouped).applyInArrow(send_anchors, _SENT).groupBy("bucket").applyInArrow(shared_anchors, _REPLY)
    second = (
        by_group(grouped).cogroup(first.groupBy("g")).applyInArrow(send_whole, _SENT)
        .groupBy("bucket").applyInArrow(smaller_elsewhere, _REPLY)
    )
    span = StructType([StructField("start", IntegerType()), StructField("end", IntegerType())])
    schema = StructType(
        [*docs.schema.fields, StructField(words_col, LongType()), StructField(spans_col, ArrayType(span)), StructField(kept_col, StringType())]
    )
    return by_group(grouped).cogroup(second.groupBy("g")).applyInArrow(finish, schema)


def _replies(table: pa.Table, n: list[int], bits: np.ndarray) -> pa.Table:
    """The bits of each row of a bucket, for rows that have any."""
    rows, at = [], 0
    for g, bucket, kind, k in zip(*(table.column(c).to_pylist() for c in ("g", "bucket", "kind")), n, strict=True):
        own = bits[at : at + k]
        at += k
        if own.any():
            rows.append((g, bucket, kind, packed.pack_bits(own)))
    return _table(rows, _REPLY)


def n_removed(spans) -> F.Column:
    """Words in the ranges of ``removed``."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the repeated words; columns unchanged.

    A text that loses words becomes the rest joined by one space, others stay as they
    are; a document that loses all its words goes, one that never had any stays.
    """
    n, spans, kept = fresh(docs, "_n", "_spans", "_kept")
    marked = mark_repeats(docs, id_col, text_col, window, n, spans, kept)
    lost = n_removed(col(spans))
    text = F.when(lost > 0, col(kept)).otherwise(col(text_col))
    return marked.where((lost == 0) | (lost < col(n))).select(
        *[text.alias(c) if c == text_col else col(c) for c in docs.columns]
    )
