import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablelab.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_vocabulary(docs, misspell=True):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if misspell and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def edits(word, known):
    """Known words one edit away, by comparing with all."""
    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    return [w for w in known if w != word and near(word, w)]


def plain_groups(known, ratio=10):
    near = {w: edits(w, known) for w in known}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-known[o], o))
            if known[best] >= ratio * known[w]:
                form[w] = best
    out = set()
    for w, n in known.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, n, len(near[w]), form.get(w), known[form[w]] if w in form else None, root))
    return out


def words_like(rng, n, letters="abcdé", sizes=(1, 6, 7, 8, 9)):
    return ["".join(rng.choices(letters, k=rng.choice(sizes))) for _ in range(n)]


def test_vocabulary_against_plain_counting(spark):
    rng = random.Random(2)
    pool = words_like(rng, 120, "abcÀÿ×Z", (5, 6, 7, 8, 12))
    docs = [(i, " ".join(rng.choices(pool, k=40)) + rng.choice([".", "1x", "\u0100", "-"])) for i in range(150)]
    docs += [(None, "Straßenbahn straßenbahn"), (7, None), (8, ""), (9, "123 ..."), (9, "Straßenbahn " * 5000), (9, "Straßenbahn " * 5000)]
    df = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, Run int")
    got = {r["word"]: r["n"] for r in spelling.vocabulary(df, misspell=spelling.drop_a_letter).collect()}
    assert got == plain_vocabulary(docs)
    assert {r["word"]: r["n"] for r in spelling.vocabulary(df).collect()} == plain_vocabulary(docs, misspell=False)


@pytest.mark.parametrize(("sample", "cell", "part"), [(200_000, 2000, 8000), (200, 40, 8000), (300, 60, 25), (10, 5, 3)])
def test_groups_against_all_pairs(spark, sample, cell, part):
    rng = random.Random(sample)
    known = {w: rng.choice([2, 3, 25, 40, 500, 9000]) for w in words_like(rng, 700, "abcdeé") + words_like(rng, 300, "aąбz", (2, 3, 4, 30))}
    known |= {"a" * 500: 3, "a" * 499 + "b": 80, "x": 5, "": 4, "y": 60}
    df = spark.createDataFrame([(w, n, "o") for w, n in known.items()], "word string, n long, other string").repartition(3)
    got = spelling.group_variants(df, sample=sample, cell=cell, part=part).collect()
    assert len(got) == len(known) and {tuple(r) for r in got} == plain_groups(known)


def test_long_chains_end_at_the_root(spark):
    chain = {"a" * (7 + k): 2 * 3**k for k in range(30)}
    df = spark.createDataFrame(list(chain.items()), "word string, n long")
    got = {tuple(r) for r in spelling.group_variants(df, ratio=3).collect()}
    assert got == plain_groups(chain, ratio=3) and {r[5] for r in got} == {"a" * 36}
    with pytest.raises(ValueError):
        spelling.group_variants(df, ratio=1)


def test_boxes_lose_no_neighbour_and_prune():
    rng = random.Random(9)
    words = sorted(set(words_like(rng, 4000, "abcdefgh", (8,))))
    counts = spelling.letter_counts(words)
    tree = spelling.Tree(counts, 16)
    own, visited = tree.own(counts), 0
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(words)))
    seen = {}
    for leaf, rows in tree.near(counts, 1):
        visited += len(rows)
        for q in rows.tolist():
            seen.setdefault(q, set()).add(leaf)
    for q in range(0, len(words), 37):
        gap = counts - counts[q]
        near = np.flatnonzero((np.maximum(gap, 0).sum(axis=1) <= 1) & (np.maximum(-gap, 0).sum(axis=1) <= 1))
        assert {int(own[k]) for k in near} <= seen[q]
    assert visited < 0.5 * len(words) * len(tree.leaves)


def test_empty_and_null_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.group_variants(empty).count() == 0
    some = spark.createDataFrame([(None, 4), ("lonely", 2)], "word string, n long")
    assert [tuple(r) for r in spelling.group_variants(some).collect()] == [("lonely", 2, 0, None, None, "lonely")]
