"""Word windows of many documents as packed columns.

Operators that must compare every word window of a corpus would shuffle a row per word.
Here documents are dealt into groups of a few megabytes; a group sends, for each hash
bucket, one row with its distinct window hashes as packed bytes, and gets one row back
with an answer per hash, in the same order.  Spark does the dealing, grouping and
joining; numpy works within one group or bucket, whose sizes ``sizes`` chooses.

A hash met in most documents is sent once per group, so no bucket grows with the
number of copies of a passage.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.llm.common import col

#: Text of a group and of a bucket, as long as a packed row then holds enough hashes.
GROUP_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
#: Hashes a packed row holds at least, and bytes of text that one hash stands for, about.
ROW_HASHES, HASH_BYTES = 64, 6
#: Sent bits of a hash besides those that name its bucket.
SENT_BITS = 40
#: Odd multipliers for rolling and mixing (fixed values: golden ratio, and the two of
#: the well-known 64-bit finaliser).
GOLDEN, MIX1, MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
NULL_ID = np.iinfo(np.int64).max


def sizes(total: int, group_bytes: int, bucket_bytes: int) -> tuple[int, int]:
    """Bytes of text of a group and of a bucket for ``total`` bytes.

    A group sends a row to each bucket, so a row holds ``group * bucket / total`` bytes' worth
    of hashes: sizes that stay as they are would bring it down to a row per word.  Where it
    would hold fewer than ``ROW_HASHES``, groups grow up to the size of buckets, then both with
    the square root of the corpus: 46 MB each at 3 TB, 264 MB each at 100 TB, which takes some
    4 GB of memory a task.
    """
    need = 2 * ROW_HASHES * HASH_BYTES * total  # twice, as buckets are a power of two
    if group_bytes * bucket_bytes >= need:
        return group_bytes, bucket_bytes
    largest = max(group_bytes, bucket_bytes)
    if group_bytes < largest and need <= largest * bucket_bytes:
        return -(-need // bucket_bytes), bucket_bytes
    side = math.isqrt(need) + 1
    return max(group_bytes, side), max(bucket_bytes, side)


def dealt(docs: DataFrame, id_col: str, text_col: str, group_col: str, total: int | None = None) -> tuple[DataFrame, int]:
    """``docs`` with a group number, and how many bits name a bucket.

    The counts of groups and buckets follow the bytes of text (``sizes``): ``total``, or measured by
    one scan.  Rows that share an id but not their text are spread.
    """
    if total is None:
        total = docs.agg(F.sum(F.octet_length(col(text_col)).cast("long"))).first()[0] or 0
    group, bucket = sizes(total, GROUP_BYTES, BUCKET_BYTES)
    groups = total // group + 1
    bits = max(1, int(total // bucket).bit_length())
    return docs.withColumn(group_col, F.pmod(F.xxhash64(col(id_col), col(text_col)), F.lit(groups)).cast("long")), bits


class WordHashes(dict):
    """64-bit hash of a word, remembered for words met before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def rolling(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive word hashes; empty if there are fewer."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = ids[:n].copy()
    for j in range(1, k):
        out *= GOLDEN
        out += ids[j : n + j]
    return mix64(out)


class Texts:
    """Words of the documents of a group, one after another, with their hashes."""

    def __init__(self, ids: pa.ChunkedArray, words: Iterable[list[bytes]]):
        memory = WordHashes()
        self.words = list(words)
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.n = int(self.ends[-1]) if len(self.ends) else 0
        self.hashes = np.empty(self.n, np.uint64)
        for w, a, b in zip(self.words, self.starts, self.ends, strict=True):
            self.hashes[a:b] = np.fromiter(map(memory.__getitem__, w), np.uint64, len(w))
        self.ids = np.array([NULL_ID if x is None else x for x in ids.to_pylist()], np.int64)
        self.doc = np.repeat(np.arange(len(self.words)), self.lengths)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``k`` words within a document, and where they start."""
        hashed = rolling(self.hashes, k)
        at = np.flatnonzero(self.doc[: len(hashed)] == self.doc[k - 1 :]) if len(hashed) else np.empty(0, np.int64)
        return hashed[at], at


def runs(values: np.ndarray) -> Iterable[tuple[int, slice]]:
    """Each run of equal values, none below 0."""
    edges = np.append(np.flatnonzero(np.diff(values, prepend=-1)), len(values)).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        yield int(values[a]), slice(a, b)


def split_buckets(sorted_keys: np.ndarray, bits: int) -> Iterable[tuple[int, slice]]:
    """The runs of each bucket in sorted keys of ``bits + SENT_BITS`` bits."""
    return runs((sorted_keys >> np.uint64(SENT_BITS)).astype(np.int64))


def cut(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of a hash that name its bucket and that are sent."""
    return hashes >> np.uint64(64 - bits - SENT_BITS)


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each 64-bit value, column by column (alike bytes together)."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((flat.shape[1], 8), np.uint8)
    out[:, :width] = flat.T
    return out.reshape(-1).view("<u8")


def width_of(values: np.ndarray) -> int:
    """Bytes that the largest value takes."""
    return max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)
