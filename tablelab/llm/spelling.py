"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word's vector counts its letters.  One replaced letter moves the vector by one up and
one down (an L1 distance of two), one inserted letter by one up.  So the words near a word
of length L lie within that distance in the tree of length L, and those with one letter
more in the tree of length L + 1; each such pair of lengths is searched.

The upper part of the trees, one for each length, is fitted on a bounded sample of the
words (``SAMPLE_WORDS``): median splits of the letter that halves best, down to cells.
Every word is indexed: it belongs to one cell of its length and is sent as a query to
each cell whose box is near enough.  Words of a cell are gathered by a shuffle; there a
k-d tree of the cell goes down to leaves of some hundred words, boxes too far away are
pruned for all queries at once, distances within a leaf are one product of matrices, and pairs
that are left are compared letter by letter.  Cells that hold more words than the sample
foretold are dealt into parts, and their queries go to every part.

Only words and counts are shuffled, and of pairs only what is near.  Forms are chosen by
partial aggregation; roots are found by pointer doubling, a few rounds, as each form is at
least ``RATIO`` times as frequent as its word.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.llm.common import col, settled

#: A letter of a word.
LETTER = "[A-Za-zÀ-ÿ]"
MIN_CHARS, MIN_COUNT, RATIO = 7, 2, 10
#: Words that the upper trees are fitted on; words a cell should hold, and may hold before it is dealt.
SAMPLE_WORDS, CELL_WORDS, PART_WORDS = 100_000, 4_000, 32_000
#: Words of a leaf of a cell's own tree.
LEAF_WORDS = 192
#: Counters of a vector: a to z, and a few that all other letters share.
DIMS = 32
NEAR = "word string, n long, other string, other_n long"


def drop_a_letter(doc_id: Column, run: Column) -> Column:
    """A reproducible misspelling: of one in 31 pairs of document and word a letter goes."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    misspell: Callable[[Column, Column], Column] | None = None, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
) -> DataFrame:
    """``(word, n)``: the words of all texts, A-Z lower-cased, with their number.

    Words are maximal runs of letters of ``min_chars`` or more (after ``misspell``, if
    given) met ``min_count`` times or more.  A null or letterless text has none; repeated
    rows count again; a null id is an empty one to ``misspell``.  Counts are added up before
    the shuffle, so a word met everywhere is a row per task.
    """
    # Runs too short to become words aren't even taken out.
    found = F.regexp_extract_all(col(text_col), F.lit(f"{LETTER}{{{min_chars},}}"), F.lit(0))
    runs = docs.select(col(id_col).alias("id"), F.explode(found).alias("run"))
    # Most runs have no capital: only the others are translated, letter by letter.
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = runs.withColumn("run", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(lower))
    word = misspell(F.col("id"), F.col("run")) if misspell else F.col("run")
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= min_chars) & (F.col("n") >= min_count))


def letter_counts(words: list[str]) -> np.ndarray:
    """A row of ``DIMS`` counts per word; letters that share a counter only bring words nearer."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % (DIMS - 26)).astype(np.int64)
    cell = np.repeat(np.arange(len(words)) * DIMS, lengths) + letter
    return np.bincount(cell, minlength=len(words) * DIMS).reshape(-1, DIMS).astype(np.int32)


def best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that halve the rows best (``<=`` goes left); None if all are alike."""
    best, choice, half = 0, None, len(counts) // 2
    middle = np.partition(counts, half, axis=0)[half]
    for step in (0, 1):
        at = middle - step
        left = (counts <= at).sum(axis=0)
        smaller = np.minimum(left, len(counts) - left)
        d = int(smaller.argmax())
        if smaller[d] > best:
            best, choice = int(smaller[d]), (d, int(at[d]))
    return choice


class Tree:
    """A k-d tree of integer points; its leaves are numbered."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.nodes: list[tuple[int, int, int, int]] = []
        self.leaves: list[np.ndarray] = []
        self._grow(points, np.arange(len(points)), leaf)

    def _grow(self, points: np.ndarray, rows: np.ndarray, leaf: int) -> int:
        """Adds the node of ``rows`` and those below; a leaf k is the number -1 - k."""
        split = best_split(points[rows]) if len(rows) > leaf else None
        if split is None:
            self.leaves.append(rows)
            return -len(self.leaves)
        here = len(self.nodes)
        self.nodes.append((0, 0, 0, 0))
        left = points[rows, split[0]] <= split[1]
        self.nodes[here] = (*split, self._grow(points, rows[left], leaf), self._grow(points, rows[~left], leaf))
        return here

    def own(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point belongs to."""
        out = np.zeros(len(points), np.int64)
        stack = [(0 if self.nodes else -1, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                out[rows] = -1 - node
            else:
                d, at, low, high = self.nodes[node]
                left = points[rows, d] <= at
                stack += [(low, rows[left]), (high, rows[~left])]
        return out

    def near(self, points: np.ndarray, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the points whose boxes lie within one count up and ``down`` counts down.

        A box's distance is that of its nearest corner, letter by letter: what must be
        added to and taken from a point to enter it.  Both are kept on the way down.
        """
        none = np.zeros(len(points), np.int32)
        stack = [(0 if self.nodes else -1, np.arange(len(points)), {}, none, none)]
        while stack:
            node, rows, box, up, dn = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                yield -1 - node, rows
                continue
            d, at, low, high = self.nodes[node]
            x, (least, most) = points[rows, d], box.get(d, (0, 1 << 30))
            # Entering the left half may take counts away, entering the right half may add some.
            fall = dn + np.maximum(x - at, 0) - np.maximum(x - most, 0)
            rise = up + np.maximum(at + 1 - x, 0) - np.maximum(least - x, 0)
            keep = fall <= down
            stack.append((low, rows[keep], box | {d: (least, min(most, at))}, up[keep], fall[keep]))
            keep = rise <= 1
            stack.append((high, rows[keep], box | {d: (max(least, at + 1), most)}, rise[keep], dn[keep]))


def spelled(words: list[str]) -> np.ndarray:
    """The code points of words of one length, a row per word."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes.reshape(len(words), -1) if len(codes) else np.empty((len(words), 0), np.uint32)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row whether b is a with one letter replaced, or with one more."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= n


def near_pairs(queries: list[str], words: list[str], tree: Tree, counts: np.ndarray, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (queries, words) of all pairs one edit apart: one count up, ``down`` counts down.

    Queries are of one length, and so are the words.  Of words with as many letters the
    squared distance is then at most two, of words with one letter more it is one:
    |q|^2 + |w|^2 - 2 q.w, in whole numbers."""
    if not queries or not words:
        return
    asked, letters, its_letters = letter_counts(queries), spelled(queries), spelled(words)
    exact = np.float32 if len(words[0]) < 2000 else np.float64
    q, w = asked.astype(exact), counts.astype(exact)
    q_norm, w_norm = (q * q).sum(axis=1), (w * w).sum(axis=1)
    at_once = max(1, (1 << 21) // max(1, len(words[0])))
    for leaf, rows in tree.near(asked, down):
        members = tree.leaves[leaf]
        its, norm = w[members].T, w_norm[members] - (1 + down)
        step = max(1, (1 << 20) // len(members))
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            hits = np.flatnonzero(2 * (q[part] @ its) >= q_norm[part][:, None] + norm)
            for h in range(0, len(hits), at_once):
                i, j = part[hits[h : h + at_once] // len(members)], members[hits[h : h + at_once] % len(members)]
                near = one_edit(letters[i], its_letters[j])
                yield i[near], j[near]


def fit_trees(words: DataFrame, sample: int = SAMPLE_WORDS, cell: int = CELL_WORDS) -> dict[int, Tree]:
    """For each length of words with more than ``cell`` words a tree whose leaves are its cells.

    Fitted on the words whose hash falls below a share of all hashes, ``sample`` of them up to
    chance (all, if there are fewer).  A length's part of the sample is split until its
    cells stand for ``cell`` words each, or for 16 words of the sample: the trees have no
    more than a sixteenth of the sample in cells.
    """
    total = words.count()
    share = min(1.0, sample / max(total, 1))
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 32)) < int(share * (1 << 32))
    by_length: dict[int, list[str]] = {}
    for w in words.where(drawn).select("word").toPandas()["word"]:
        by_length.setdefault(len(w), []).append(w)
    return {n: Tree(letter_counts(group), max(16, math.ceil(cell * share))) for n, group in by_length.items() if len(group) > cell * share}


def routed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """``(len, cell, kind, word, n)``: each word at home in its cell (kind 0) and as a query, of its own length (1) or of
    one letter less (2), in every cell near it."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, n = batch.column("word").to_pylist(), np.array(batch.column("n").to_pylist(), np.int64)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            counts = letter_counts(found)
            out = []
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                own = trees.get(size)
                out.append((at, size, own.own(counts[at]) if own else 0, 0))
                for kind, other, down in ((1, size, 1), (2, size + 1, 0)):
                    cells = trees[other].near(counts[at], down) if other in trees else [(0, np.arange(len(at)))]
                    out += [(at[rows], other, leaf, kind) for leaf, rows in cells]
            place = np.concatenate([x[0] for x in out]) if out else np.empty(0, np.int64)
            spread = lambda k: np.concatenate([np.broadcast_to(x[k], len(x[0])) for x in out]) if out else np.empty(0, np.int64)
            taken = pa.array(place)
            yield pa.RecordBatch.from_arrays(
                [pa.array(spread(1), pa.int32()), pa.array(spread(2), pa.int32()), pa.array(spread(3), pa.int32()),
                 batch.column("word").take(taken), pa.array(n[place] if len(place) else place, pa.int64())],
                names=["len", "cell", "kind", "word", "n"],
            )

    # Words of one length side by side: a batch then meets few trees.
    return words.select("word", "n").sortWithinPartitions(F.length("word")).mapInArrow(route, "len int, cell int, kind int, word string, n long")


def near_words(words: DataFrame, sample: int = SAMPLE_WORDS, cell: int = CELL_WORDS, part: int = PART_WORDS) -> DataFrame:
    """``(word, n)``, words distinct, to ``NEAR``: a row for each word and each word one edit from it."""
    placed = settled(routed(words, fit_trees(words, sample, cell)), "spelling-cells")
    # A row per cell, of which there are at most a sixteenth of the sample and one per length.
    sizes = settled(placed.where("kind = 0").groupBy("len", "cell").agg((F.floor(F.count("*") / part) + 1).cast("int").alias("parts")), "spelling-parts")
    joined = placed.join(sizes, ["len", "cell"])
    home = F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    dealt = joined.withColumn("part", F.explode(F.when(F.col("kind") == 0, home).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))))

    def search(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        all_words = table.column("word").to_pylist()
        members = np.flatnonzero(kinds == 0)
        words = [all_words[k] for k in members]
        counts = letter_counts(words)
        tree = Tree(counts, LEAF_WORDS)
        pairs = [(np.empty(0, np.int64),) * 2]
        for kind, down in ((1, 1), (2, 0)):
            asked = np.flatnonzero(kinds == kind)
            for i, j in near_pairs([all_words[k] for k in asked], words, tree, counts, down):
                pairs.append((asked[i], members[j]))
                if kind == 2:  # of two lengths only the shorter word asks
                    pairs.append((members[j], asked[i]))
        left, right = (pa.array(np.concatenate(x)) for x in zip(*pairs, strict=True))
        word, n = table.column("word"), table.column("n")
        return pa.table({"word": word.take(left), "n": n.take(left), "other": word.take(right), "other_n": n.take(right)})

    return dealt.groupBy("len", "cell", "part").applyInArrow(search, NEAR)


def roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """``(word, form)`` to ``(word, root)`` by doubling: after k rounds 2 ** k forms have been followed.

    A chain has at most log(most) / log(ratio) steps, as counts grow by ``ratio`` each."""
    steps = math.floor(math.log(max(most, 1)) / math.log(ratio)) + 1
    found = forms.select("word", F.col("form").alias("root"))
    for k in range(max(steps, 1).bit_length()):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = settled(found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"spelling-roots-{k}")
    return found


def group_variants(words: DataFrame, ratio: int = RATIO, sample: int = SAMPLE_WORDS, cell: int = CELL_WORDS, part: int = PART_WORDS) -> DataFrame:
    """``(word, n)``, words distinct, to ``(word, n, n_near, form, form_n, root)``, a row per word.

    ``n_near`` counts the words one inserted, deleted or replaced letter away, ``form`` is
    the most frequent of them (ties: the first in code-point order) if it is ``ratio`` times
    as frequent as the word, ``root`` the end of the chain of forms, the word itself if it
    has none.  ``ratio`` is at least 2.  Words of any length and letters; null words are
    left out.  An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2: forms would not end")
    words = settled(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    most = words.agg(F.max("n")).first()[0] or 1
    near = near_words(words, sample, cell, part)
    # The largest count, then the first word: the least of (-count, word).
    best = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other"))).alias("best"))
    big = -F.col("best.m") >= ratio * F.col("n")
    best = settled(
        best.select("word", "n_near", F.when(big, F.col("best.other")).alias("form"), F.when(big, -F.col("best.m")).alias("form_n")), "spelling-forms"
    )
    ends = roots(best.where("form is not null"), most, ratio)
    return words.join(best, "word", "left").join(ends, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )
