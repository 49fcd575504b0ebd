"""N-gram Jaccard join by sizes: light sets enumerate subsets, heavy sets scan inverted lists.

A document's set is its distinct word shingles; two documents link if
``100 * intersection >= percent * union``.  Identical sets count as one class from the
start.  Of the others:

* Light sets (few shingles) enumerate every subset that a linked partner can share.  Of
  the sets with one subset in common, all link with the smallest if they link at all, so
  a subset gives a star, not pairs.
* Heavy sets are ordered rarest shingle first; linked sets share a shingle of their
  prefixes, so inverted lists hold prefixes only, without shingles of a single document.
  A list first compares everybody with its most central member.  Once components are
  known, lists whose members are all in one are done; in the others members outside the
  centre's component are compared with those of other components.  No link between
  components can be missed, and a large group of near copies is never paired out.
* A list that is still long then holds many sets that share a shingle and little else.  Its
  members are dealt anew: linked sets differ in at most h shingles, so if all shingles
  are dealt into h + 1 parts by hash, the sets agree in one part at least.  Members
  meet by (part, what they have in it) instead of by the one shingle.

The boundary is the size at which enumerating subsets and scanning lists cost least in
all, over the sizes that the table has.  Light sets that a heavy one can link with are in
the lists as well.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.llm import packed
from tablelab.llm.common import ASCII_LOWER, col, fresh, settled
from tablelab.llm.components import components
from tablelab.session import scratch_dir

SHINGLE = 3
PERCENT = 90
#: What scanning the list of one shingle and verifying costs, in rows of a subset.
SCAN_COST = 8
#: Sizes counted apart when the boundary is chosen; members outside the centre's component that make a list long.
COUNTED_SIZES, LONG_LIST = 256, 32
#: Longs of a parity sketch.
SKETCH_LONGS = 16
_SENT = "g long, bucket long, kind int, n long, keys binary, extra binary"
_REPLY = "g long, bucket long, kind int, extra binary"
_COUNT, _SET = 0, 1
_INDEX = (
    "id long, n long, rep long, subsets array<struct<key: long, size: int>>, "
    "tokens array<struct<token: long, pos: int>>, shingles binary"
)
_SET_BYTES = 8


def spare(n: int, percent: int) -> int:
    """How many of a set's ``n`` shingles a linked set can lack."""
    return n - -(-percent * n // 100)


def light_boundary(percent: int = PERCENT, scan_cost: float = SCAN_COST) -> int:
    """The largest size below which enumerating subsets is cheaper than scanning lists."""
    n = 0
    while sum(math.comb(n + 1, k) for k in range(spare(n + 1, percent) + 1)) <= scan_cost * (spare(n + 1, percent) + 1):
        n += 1
    return n


def chosen_boundary(sizes: dict[int, int], percent: int = PERCENT, scan_cost: float = SCAN_COST) -> int:
    """The boundary of least cost for ``sizes``, numbers of sets by size (of the largest counted size, or more).

    Sets up to the boundary send a row for each subset; all that a set above it can link with
    send one of ``scan_cost`` for each shingle of their prefix."""
    most = light_boundary(percent, scan_cost)

    def cost(boundary: int) -> float:
        listed = -(-percent * (boundary + 1) // 100)
        light = sum(c * math.comb(n, k) for n, c in sizes.items() if n <= boundary for k in range(spare(n, percent) + 1))
        return light + scan_cost * sum(c * (spare(n, percent) + 1) for n, c in sizes.items() if n >= listed)

    # Beyond the size at which a set's own subsets cost more, no larger boundary is cheaper.
    return min(range(most + 1), key=lambda b: (cost(b), b))


def size_classes(most: int, percent: int) -> list[int]:
    """First sizes of classes such that linked sets are in one class or in neighbouring ones."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * 100 // percent + 1)
    return out + [out[-1] * 100 // percent + 1, (out[-1] * 100 // percent + 1) * 100 // percent + 1]


def part_keys(shingles: np.ndarray, percent: int) -> list[dict]:
    """Keys of a set's parts: sets that link have a key in common.

    A set takes part in the pair of its own class of sizes and the next, and in that of the
    class before and its own.  Sets of a pair of classes that link differ in at most ``h``
    shingles; each pair has ``h + 1`` parts."""
    first = size_classes(len(shingles), percent)
    own = bisect_right(first, len(shingles)) - 1
    hashes, out = packed.mix64(shingles), []
    for pair in {max(own - 1, 0), own}:
        largest = first[pair + 2] - 1
        parts = (100 - percent) * 2 * largest // (100 + percent) + 1
        part = (hashes % np.uint64(parts)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, packed.mix64(hashes ^ packed.GOLDEN))
        keys = packed.mix64(sums ^ packed.mix64(np.arange(parts, dtype=np.uint64) + np.uint64(pair << 32)))
        out += [{"pair": pair, "key": k} for k in keys.view(np.int64).tolist()]
    return out


def parity(shingles: np.ndarray) -> list[int]:
    """``SKETCH_LONGS`` longs whose bits tell whether an odd number of shingles falls on them."""
    bits = packed.mix64(shingles ^ packed.MIX1) % np.uint64(64 * SKETCH_LONGS)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, types[t]) for n, t in (x.split() for x in ddl.split(", "))])


class _Group:
    """The distinct shingles of a group's documents: sorted by document, then hash."""

    def __init__(self, table: pa.Table, shingle: int):
        texts = table.column("text").to_pylist()
        words = ([] if t is None else t.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() for t in texts)
        self.texts = t = packed.Texts(table.column("id"), words)
        hashes, at = t.windows(shingle)
        doc = t.doc[at]
        short = np.flatnonzero((t.lengths > 0) & (t.lengths < shingle))
        if len(short):
            whole = [packed.rolling(t.hashes[t.starts[d] : t.ends[d]], int(t.lengths[d]))[0] ^ np.uint64(t.lengths[d]) for d in short]
            hashes, doc = np.append(hashes, np.array(whole, np.uint64)), np.append(doc, short)
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        self.hashes, self.doc = hashes[new], doc[new]
        self.n = np.bincount(self.doc, minlength=len(t.lengths))
        self.ends = np.cumsum(self.n)
        self.starts = self.ends - self.n
        self.signs = [xxhash.xxh3_128_digest(self.hashes[a:b].tobytes()) if b > a else None for a, b in zip(self.starts, self.ends, strict=True)]

    def keys(self, bits: int):
        """Distinct cut hashes, sorted, and the place of each shingle among them."""
        return np.unique(packed.cut(self.hashes, bits), return_inverse=True)

    def sets(self, bits: int) -> dict[int, dict[bytes, int]]:
        """By bucket: each signature with the least id that has it; in order."""
        out: dict[int, dict[bytes, int]] = {}
        for sign, i in sorted((s, int(i)) for s, i in zip(self.signs, self.texts.ids, strict=True) if s):
            out.setdefault(int.from_bytes(sign[:8], "little") >> (64 - bits), {}).setdefault(sign, i)
        return out


def build_index(docs: DataFrame, shingle: int, percent: int, boundary: int, total: int | None = None) -> DataFrame:
    """``(id, text)`` to ``_INDEX``: for each document its size, the least id of its set and,
    for one document of each set, what it joins by."""
    docs = docs.select("id", "text")
    grouped, bits = packed.dealt(docs, "id", "text", "g", total)
    sent, reply_schema = _arrow(_SENT), _arrow(_REPLY)
    in_lists = -(-percent * (boundary + 1) // 100)  # the smallest set that a heavy one can link with

    def send(table: pa.Table) -> pa.Table:
        group, number, rows = _Group(table, shingle), table.column("g")[0].as_py(), []
        keys, place = group.keys(bits)
        met = np.minimum(np.bincount(place, minlength=len(keys)), 255).astype(np.uint8)
        for bucket, part in packed.split_buckets(keys, bits):
            rows.append((number, bucket, _COUNT, part.stop - part.start, packed.pack(keys[part], packed.SENT_BITS // 8), met[part].tobytes()))
        for bucket, found in group.sets(bits).items():
            rows.append((number, bucket, _SET, len(found), b"".join(found), np.array(list(found.values()), np.int64).tobytes()))
        return _rows(rows, sent)

    def answer(table: pa.Table) -> pa.Table:
        """Of a bucket: in how many documents each shingle is, as a power of two, and the least id of each set."""
        rows, least, lists = [], {}, []
        for row in table.to_pylist():
            if row["kind"] == _COUNT:
                lists.append((row, packed.unpack(row["keys"], packed.SENT_BITS // 8), np.frombuffer(row["extra"], np.uint8)))
            else:
                signs = [row["keys"][i : i + 16] for i in range(0, len(row["keys"]), 16)]
                for sign, i in zip(signs, np.frombuffer(row["extra"], np.int64).tolist(), strict=True):
                    least[sign] = min(i, least.get(sign, i))
        for row in table.filter(pa.compute.equal(table.column("kind"), _SET)).to_pylist():
            signs = [row["keys"][i : i + 16] for i in range(0, len(row["keys"]), 16)]
            rows.append((row["g"], row["bucket"], _SET, np.array([least[s] for s in signs], np.int64).tobytes()))
        if lists:
            keys = np.concatenate([k for _, k, _ in lists])
            order = np.argsort(keys, kind="stable")
            new = np.flatnonzero(np.diff(keys[order], prepend=keys[order[0]] ^ np.uint64(1)))
            total = np.add.reduceat(np.concatenate([m for _, _, m in lists])[order].astype(np.int64), new)
            power = np.ceil(np.log2(total)).astype(np.uint8)
            out = np.empty(len(keys), np.uint8)
            out[order] = np.repeat(power, np.diff(np.append(new, len(keys))))
            at = 0
            for row, k, _ in lists:
                own = out[at : at + len(k)]
                at += len(k)
                if own.any():
                    rows.append((row["g"], row["bucket"], _COUNT, own.tobytes()))
        return _rows(rows, reply_schema)

    def index(table: pa.Table, reply: pa.Table) -> pa.Table:
        group = _Group(table, shingle)
        told = {(r["kind"], r["bucket"]): r["extra"] for r in reply.to_pylist()}
        least: dict[bytes, int] = {}
        for bucket, found in group.sets(bits).items():
            least |= zip(found, np.frombuffer(told[_SET, bucket], np.int64).tolist(), strict=True)
        keys, place = group.keys(bits)
        rarity = np.zeros(len(keys), np.uint8)
        for bucket, part in packed.split_buckets(keys, bits):
            if (_COUNT, bucket) in told:
                rarity[part] = np.frombuffer(told[_COUNT, bucket], np.uint8)
        rarity = rarity[place]
        rows, done = [], set()
        for d, (a, b, sign) in enumerate(zip(group.starts, group.ends, group.signs, strict=True)):
            i, n = int(group.texts.ids[d]), int(b - a)
            named = i != packed.NULL_ID
            rep = (least[sign] if sign else i) if named else None
            subsets, tokens, shingles = [], [], None
            if named and sign and rep == i and sign not in done:
                done.add(sign)
                own = group.hashes[a:b]
                if n <= boundary:
                    subsets = _subsets(own, spare(n, percent))
                if n >= in_lists:
                    order = np.lexsort((own, rarity[a:b]))[: spare(n, percent) + 1]
                    tokens = [{"token": int(t), "pos": p} for p, (t, r) in enumerate(zip(own[order].view(np.int64).tolist(), rarity[a:b][order].tolist(), strict=True)) if r]
                if tokens:
                    shingles = packed.pack(np.unique(own >> np.uint64(64 - 8 * _SET_BYTES)), _SET_BYTES)
            rows.append((i if named else None, n, rep, subsets, tokens, shingles))
        return _rows(rows, pa.schema([
            ("id", pa.int64()), ("n", pa.int64()), ("rep", pa.int64()),
            ("subsets", pa.list_(pa.struct([("key", pa.int64()), ("size", pa.int32())]))),
            ("tokens", pa.list_(pa.struct([("token", pa.int64()), ("pos", pa.int32())]))), ("shingles", pa.binary()),
        ]))

    answers = grouped.groupBy("g").applyInArrow(send, _SENT).groupBy("bucket").applyInArrow(answer, _REPLY)
    return grouped.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(index, _INDEX)


def _subsets(own: np.ndarray, lacking: int) -> list[dict]:
    """Keys of the set without up to ``lacking`` of its shingles: sums of their hashes."""
    values, total = [int(x) for x in packed.mix64(own)], int(np.sum(packed.mix64(own), dtype=np.uint64))
    out = []
    for k in range(lacking + 1):
        for gone in combinations(values, k):
            key = (total - sum(gone)) & 0xFFFFFFFFFFFFFFFF
            out.append({"key": key - (1 << 64) if key >> 63 else key, "size": len(values) - k})
    return out


def _light_links(index: DataFrame, percent: int) -> DataFrame:
    """Sets that share an enumerated subset link with the smallest of them."""
    sub = index.select("id", "n", F.explode("subsets").alias("s")).select("id", "n", "s.key", "s.size")
    centres = sub.groupBy("key", "size").agg(F.min(F.struct("n", "id")).alias("c"), F.count("*").alias("met")).where("met > 1")
    near = 100 * F.col("size") >= percent * (F.col("n") + F.col("c.n") - F.col("size"))
    return sub.join(centres, ["key", "size"]).where(near & (F.col("id") != F.col("c.id"))).select(F.col("id").alias("a"), F.col("c.id").alias("b"))


def _possible(a: str, b: str, percent: int) -> F.Column:
    """Whether sets may link whose first common shingle has these positions."""
    rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return (100 + percent) * rest >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _verified(pairs: DataFrame, index: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of ids, each once, whose sets link."""

    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(
            [len(np.intersect1d(packed.unpack(a, _SET_BYTES), packed.unpack(b, _SET_BYTES), assume_unique=True)) for a, b in zip(x, y, strict=True)],
            dtype="int64",
        )

    both = F.pandas_udf(common, "long")
    side = index.where("shingles is not null")
    pairs = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    joined = pairs.join(side.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa")), "a")
    joined = joined.join(side.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb")), "b")
    i = F.col("i")
    return joined.withColumn("i", both("sa", "sb")).where(100 * i >= percent * (F.col("na") + F.col("nb") - i)).select("a", "b")


def _heavy_links(index: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """``links`` and enough links of the inverted lists to connect whatever is connected."""
    entries = index.select("id", "n", F.explode("tokens").alias("t")).select("t.token", F.struct("t.pos", "n", "id").alias("m"))
    # The most central member: with the fewest rarer shingles.
    lists = entries.groupBy("token").agg(F.min("m").alias("c"), F.count("*").alias("met")).where("met > 1").select("token", "c")
    stars = entries.join(lists, "token").where(_possible("m", "c", percent))
    links = links.union(_verified(stars.select(F.col("m.id").alias("a"), F.col("c.id").alias("b")), index, percent))
    path = scratch_dir(index.sparkSession, "star-links")
    links.write.parquet(path)
    links = index.sparkSession.read.parquet(path)
    found = components(links)
    placed = entries.join(found, entries["m.id"] == found["id"], "left").select(
        "token", "m", F.coalesce("component", "m.id").alias("component")
    )
    mixed = placed.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min(F.struct("m", "component")).alias("c")
    ).where("low <> high").select("token", F.col("c.component").alias("central"), F.col("c.m.id").alias("centre"))
    open_lists = placed.join(mixed, "token")
    path = scratch_dir(index.sparkSession, "open-lists")
    open_lists.write.parquet(path)
    open_lists = index.sparkSession.read.parquet(path)
    # Long lists are taken apart by what their members have in common besides.
    long = open_lists.where("component <> central").groupBy("token").agg(F.count("*").alias("outer")).where(F.col("outer") > LONG_LIST).select("token")
    long = settled(long, "long-lists")
    short = open_lists.join(long, "token", "left_anti")
    outer = short.where("component <> central").select("token", "centre", F.col("m").alias("x"), F.col("component").alias("cx"))
    every = short.select("token", F.col("m").alias("y"), F.col("component").alias("cy"))
    # Pairs with the centre have been compared; of two outer members one order is enough.
    across = outer.join(every, "token").where(
        (F.col("cx") != F.col("cy")) & (F.col("y.id") != F.col("centre")) & _possible("x", "y", percent)
    ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    members = open_lists.join(long, "token").select(F.col("m.id").alias("id"), "component").distinct()
    return links.union(_verified(across.union(_part_pairs(members, index, percent)), index, percent))


def _part_pairs(members: DataFrame, index: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of members of different components that agree in a part."""

    def keys(shingles: pd.Series) -> pd.DataFrame:
        sets = [packed.unpack(x, _SET_BYTES) for x in shingles]
        rows = {"keys": [part_keys(x, percent) for x in sets], "bits": [parity(x) for x in sets]}
        return pd.DataFrame(rows, columns=["keys", "bits"], dtype=object)

    told = F.pandas_udf(keys, "keys array<struct<pair: int, key: long>>, bits array<long>")
    sets = members.join(index.where("shingles is not null").select("id", "n", "shingles"), "id").withColumn("s", told("shingles"))
    entries = sets.select("id", "n", "component", F.col("s.bits").alias("bits"), F.explode("s.keys").alias("k")).select(
        "id", "n", "component", "bits", "k.pair", "k.key"
    )
    lists = entries.groupBy("pair", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    path = scratch_dir(index.sparkSession, "part-lists")
    entries.join(lists.select("pair", "key"), ["pair", "key"]).write.parquet(path)
    met = index.sparkSession.read.parquet(path)
    x = met.select("pair", "key", F.col("id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("bits").alias("xa"))
    y = met.select("pair", "key", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), F.col("bits").alias("xb"))
    # Sizes and sketches rule out most, in the join itself; one order of each pair is enough.
    sized = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    apart = sum((F.bit_count(F.col("xa")[k].bitwiseXOR(F.col("xb")[k])) for k in range(SKETCH_LONGS)), F.lit(0))
    close = (100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb"))
    return x.join(y, ["pair", "key"]).where((F.col("a") > F.col("b")) & (F.col("ca") != F.col("cb")) & sized & close).select("a", "b").distinct()


def link_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    scan_cost: float = SCAN_COST,
) -> DataFrame:
    """``(id, n_shingles, component)`` per row of ``docs``: the least id reachable by links.

    A-Z are lower-cased; a text of fewer words than a shingle is one shingle; without words
    or text a document has none and is its own component.  Ids are whole numbers; rows of
    one id are one node of the links; a row with a null id links with nothing and has a null
    component.  Repeated rows give repeated results.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text"))
    # Sizes as the bytes of text tell; the boundary decides what is cheaper, not what links.
    size = F.least(F.floor(F.octet_length("text") / packed.HASH_BYTES), F.lit(COUNTED_SIZES)).cast("int")
    sizes = texts.groupBy(size.alias("size")).agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).collect()
    boundary = chosen_boundary({r["size"]: r["n"] for r in sizes if r["size"]}, percent, scan_cost)
    path = scratch_dir(spark, "shingle-index")
    build_index(texts, shingle, percent, boundary, sum(r["bytes"] or 0 for r in sizes)).write.parquet(path)
    index = spark.read.parquet(path)
    # An id with several texts joins their sets.
    several = index.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high").select("id")
    own = index.join(several, "id").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct()
    found = components(_heavy_links(index, _light_links(index, percent).union(own), percent))
    named = found.select(F.col("id").alias("rep"), "component")
    return index.select("id", "n", "rep").join(named, "rep", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """The rows of ``docs`` that are the first of their class, columns unchanged.

    Rows with a null id stay; repeated rows of one id stay or go together.
    """
    key = fresh(docs, "_gone")[0]
    classes = link_classes(docs, id_col, text_col, **kwargs)
    gone = settled(classes.where("component <> id").select(F.col("id").alias(key)).distinct(), "duplicates")
    return docs.join(gone, col(id_col).cast("long") == F.col(key), "left_anti")
