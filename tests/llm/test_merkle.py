import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tablelab.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, pos int, h int, Path int"
LOWER = {c: c + 32 for c in range(65, 91)}


def H(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def up(nodes):
    """Levels of a tree, leaves first."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, pos):
    for level in levels[:-1]:
        run = level[pos - pos % 8 : pos - pos % 8 + 8]
        yield run[: pos % 8], run[pos % 8 + 1 :]
        pos //= 8


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = up([leaf(r) for r in groups[g]])
    crown = up([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for pos, row in enumerate(groups[g]):
            path = [*siblings(trees[g], pos), *siblings(crown, k)]
            low = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None
            cur = leaf((*row[:4], row[4].translate(LOWER))) if low else leaf(row)
            for left, right in path:
                cur = H(*left, cur, *right)
            root = crown[-1][0]
            out.append((row[0], leaf(row), trees[g][-1][0], root, H(*[x for p in path for side in p for x in side]), cur, cur == root))
    return sorted(out, key=repr)


def run(df):
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.verify(merkle.manifest(df, altered={"text": merkle.lower_ascii(F.col("text"))}, where=third))
    return sorted([tuple(r) for r in rows.drop("group").collect()], key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_against_plain_trees(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rng = random.Random(levels)
    rows = [(i, rng.choice(["web", None]), rng.choice(["en"] * 9 + ["de"]), rng.randint(0, 9), rng.choice(["Abc", "abc", "ÄÖ é", ""])) for i in rng.sample(range(5000), 700)]
    # A group of one, of 8, of 9, of 64 and of 65; many groups, so that the crown has levels too.
    rows += [(10_000 + k, "s", f"{n}-rows", k, "T") for n in (1, 2, 7, 8, 9, 64, 65) for k in range(n)]
    rows += [(20_000 + k, "s", f"l{k}", k, "T") for k in range(70)]
    rows += [(None, None, None, None, None), (1, None, None, None, None), (1, None, "", 3, "-"), (7, "1:a", "en", 1, "x" * 100_000)]
    rows += [(42, "twice", "en", 1, "Same")] * 3 + [(42, "twice", "en", 1, "Other")]
    assert run(frame(spark, rows).repartition(5)) == plain(rows)


def test_order_and_partitioning_do_not_matter_and_tampering_shows(spark):
    rows = [(i, "s", "en", i, "Text" if i % 2 else "text") for i in range(1500)]
    one, other = run(frame(spark, rows).repartition(1)), run(frame(spark, rows[::-1]).repartition(13))
    assert one == other
    bad = {r[0] for r in one if not r[-1]}
    assert bad == {i for i in range(1500) if i % 2 and zlib.crc32(str(i).encode()) % 3 == 0}


def test_empty_table_and_one_row(spark):
    assert run(frame(spark, []).limit(0)) == []
    got = run(frame(spark, [(5, None, None, None, None)]))
    assert got == plain([(5, None, None, None, None)]) and got[0][4] == hashlib.sha256(b"").hexdigest()


def test_texts_are_not_shuffled_and_blocks_share_one_sort(spark):
    docs = frame(spark, [(i, "s", "en", i, "t") for i in range(50)])
    plan = merkle.manifest(docs)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "Python" not in plan
