import random

import pytest

from tablelab.llm import ngram_join, packed
from tablelab.llm.components import components
from tablelab.session import scratch_dir
from tests.llm import brute


def near(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        k = rng.randrange(len(w))
        kind = rng.random()
        if kind < 0.4:
            w[k] = f"e{rng.randrange(10**6)}"
        elif kind < 0.7 and len(w) > 2:
            del w[k]
        else:
            w.insert(k, f"i{rng.randrange(10**6)}")
    return w


def fixture_docs(seed):
    rng = random.Random(seed)
    docs = []
    for g in range(14):
        n = rng.choice([1, 2, 3, 5, 9, 11, 12, 13, 21, 22, 23, 40, 90, 200])
        base = [f"w{rng.randrange(400)}" for _ in range(n)]
        for _ in range(rng.choice([1, 2, 6, 15])):
            docs.append(" ".join(near(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 5]) if n > 1 else 0)))
    # A passage that many otherwise different texts share, and a chain of small steps.
    passage = " ".join(f"p{k}" for k in range(30))
    docs += [passage + " " + " ".join(f"u{j}x{k}" for k in range(rng.randint(1, 60))) for j in range(25)]
    w = [f"c{k}" for k in range(120)]
    for _ in range(20):
        w = near(rng, w, 1)
        docs.append(" ".join(w).title())
    docs += ["", None, "  ", "one", "one", "One two", "one TWO", "É é", "é é", docs[5], docs[5]]
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    return list(zip(ids, docs, strict=True))


@pytest.mark.parametrize("seed, group, scan_cost", [(1, 2 << 20, 8), (2, 700, 8), (3, 700, 0.1), (4, 5000, 200)])
def test_against_brute_force(spark, monkeypatch, seed, group, scan_cost):
    monkeypatch.setattr(packed, "GROUP_BYTES", group)
    monkeypatch.setattr(packed, "BUCKET_BYTES", group)
    docs = fixture_docs(seed)
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, n int, component string")
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in ngram_join.link_classes(df, scan_cost=scan_cost).collect()}
    assert got == brute.classes(docs)


def test_boundary_follows_cost():
    assert ngram_join.light_boundary(scan_cost=0.1) < ngram_join.light_boundary(scan_cost=8) < ngram_join.light_boundary(scan_cost=200)


def test_edges_and_keep_one(spark):
    rows = [(5, "a b c d e", 1), (5, "a b c d e", 1), (2, "A b c d e", 2), (None, "a b c d e", 3), (7, None, 4), (8, "", 5), (9, "z", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone int")
    out = ngram_join.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or -1, r["_gone"]) for r in out.collect()) == [(-1, 3), (2, 2), (7, 4), (8, 5), (9, 6)]
    got = [(r["id"], r["component"]) for r in ngram_join.link_classes(df).collect()]
    assert sorted(got, key=str) == sorted([(5, 2), (5, 2), (2, 2), (None, None), (7, 7), (8, 8), (9, 9)], key=str)
    assert ngram_join.link_classes(df.limit(0)).count() == 0


def test_no_pairs_within_a_group_of_near_copies(spark):
    """Links grow with the group, not with its square."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(150)]
    docs = [(k, " ".join(near(rng, base, 2))) for k in range(400)]
    df = spark.createDataFrame(docs, "id long, text string")
    path = scratch_dir(spark, "test-index")
    ngram_join.build_index(df, 3, 90, ngram_join.light_boundary()).write.parquet(path)
    index = spark.read.parquet(path)
    links = ngram_join._heavy_links(index, ngram_join._light_links(index, 90), 90)
    assert links.count() < 8 * len(docs)
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert {i: got.get(i, i) for i, _ in docs} == {i: c for i, (_, c) in brute.classes(docs).items()}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(2000, k) for k in range(2001, 2200)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame([*links, (None, 1), (7, 7)], "a long, b long")).collect()}
    assert got == {i: root(i) for a, b in links if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_one_id_are_one_node(spark):
    one, two = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(2, one), (5, one), (5, two), (7, two), (8, two + " tail"), (9, "else one two")]
    got = {(r["id"], r["component"]) for r in ngram_join.link_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(2, 2), (5, 2), (7, 2), (8, 2), (9, 9)}


def test_shingles_are_compared_whole(spark):
    docs = spark.createDataFrame([(k, " ".join(f"c{j}" for j in range(60)) + f" t{k}") for k in range(2)], "id long, text string")
    sets = [r["shingles"] for r in ngram_join.build_index(docs, 3, 90, ngram_join.light_boundary()).collect() if r["shingles"]]
    assert [len(s) for s in sets] == [59 * 8] * 2 and ngram_join.light_boundary() == 15


def test_boundary_follows_the_sizes_met():
    for sizes in ({5: 100, 300: 5}, {12: 1000, 13: 10, 400: 3}, {19: 50, 21: 900}, {200: 10}, {}):
        found = ngram_join.chosen_boundary(sizes)
        assert 0 <= found <= ngram_join.light_boundary()
    assert ngram_join.chosen_boundary({200: 10}) == 0 and ngram_join.chosen_boundary({12: 1000, 300: 5}) >= 12
    # Short sets that long ones could link with would be in the lists as well: cheaper there alone.
    assert ngram_join.chosen_boundary({15: 10, 16: 100_000}) < 15


@pytest.mark.parametrize("percent", [90, 80])
def test_linked_sets_agree_in_a_part(percent):
    rng = random.Random(percent)
    for _ in range(400):
        n = rng.randint(1, 300)
        a = {rng.getrandbits(64) for _ in range(n)}
        b = set(rng.sample(sorted(a), max(1, n - rng.randint(0, n // 8)))) | {rng.getrandbits(64) for _ in range(rng.randint(0, n // 8))}
        keys = [{(k["pair"], k["key"]) for k in ngram_join.part_keys(ngram_join.np.array(sorted(x), ngram_join.np.uint64), percent)} for x in (a, b)]
        if 100 * len(a & b) >= percent * len(a | b):
            assert keys[0] & keys[1]


def verified_pairs(spark, monkeypatch, docs):
    """How many pairs are brought to verification, and the classes."""
    counted, verified = [], ngram_join._verified

    def count(pairs, index, percent):
        counted.append(pairs.count())
        return verified(pairs, index, percent)

    with monkeypatch.context() as m:
        m.setattr(ngram_join, "_verified", count)
        rows = ngram_join.link_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return sum(counted), {r["id"]: (r["n_shingles"], r["component"]) for r in rows}


def test_pairs_of_unlinked_documents_grow_linearly(spark, monkeypatch):
    rng = random.Random(6)
    docs = [(k, " ".join(rng.choices("abcdefghi", k=200))) for k in range(800)]
    pairs = {n: verified_pairs(spark, monkeypatch, docs[:n])[0] for n in (200, 400, 800)}
    assert pairs[400] <= 2.5 * pairs[200] and pairs[800] <= 2.5 * pairs[400] and pairs[800] < 60 * 800


def test_long_lists_lose_no_link(spark, monkeypatch):
    """Small vocabulary, so that lists are long, with near copies in between."""
    rng = random.Random(8)
    docs = []
    for _ in range(60):
        base = rng.choices("abcdefg", k=rng.choice([60, 90, 200]))
        for _ in range(rng.choice([1, 1, 2, 4])):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice("abcdefg")
            docs.append((len(docs), " ".join(w)))
    monkeypatch.setattr(ngram_join, "LONG_LIST", 3)
    assert verified_pairs(spark, monkeypatch, docs)[1] == brute.classes(docs)


def test_sketches_never_differ_more_than_sets():
    rng = random.Random(12)
    for n in (1, 5, 100, 3000):
        a = {rng.getrandbits(64) for _ in range(n)}
        b = set(rng.sample(sorted(a), n - n // 5)) | {rng.getrandbits(64) for _ in range(n // 6)}
        bits = [ngram_join.parity(ngram_join.np.array(sorted(x), ngram_join.np.uint64)) for x in (a, b)]
        apart = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(*bits, strict=True))
        assert apart <= len(a ^ b) and (n > 100 or apart >= 0.9 * len(a ^ b) - 1)
