import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tablelab.llm import decontam, packed
from tests.llm import brute


def fixture(seed=2):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)] + ["É", "über", "x1"]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(say(rng.choice([1, 2, 4, 5, 8, 12, 13, 14, 30])))) for k in range(20)]
    items += [(50, None), (51, " ,.! "), (52, items[7][1]), (9, items[3][1].upper()), (None, items[5][1])]
    docs = []
    for i in range(120):
        w = say(rng.randint(0, 60))
        if rng.random() < 0.5:
            own = brute.alnum(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(own) - 13))
            at = rng.randint(0, len(w))
            w[at:at] = own[a : a + rng.randint(5, 20)]
        docs.append((i, rng.choice([" ", ", ", "-", "\n"]).join(w).title()))
    docs += [(500, None), (501, ""), (500, None), (None, docs[3][1]), (None, None), (7, docs[7][1]), (8, docs[9][1]), (600, " ".join(t or "" for _, t in docs) * 8)]
    return docs, items


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SLICE_BYTES", 3000)
    docs, items = fixture()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, key string, n_words int")
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, window string")
    got = decontam.find_items(df, bench).collect()
    want = brute.benchmark_hits(docs, [(i, t) for i, t in items if i is not None])
    nulls = brute.benchmark_hits(docs, [(i, t) for i, t in items if i is None])
    assert len(got) == len(docs)
    rows = sorted((str(r["id"]), r["n_words"], r["n_hit"], r["items"]) for r in got)
    assert rows == sorted((str(i), *want[i, t][:1], max(want[i, t][1], nulls[i, t][1]), want[i, t][2]) for i, t in docs)
    assert sum(r["n_hit"] > 0 for r in got) > 20


def test_drop_and_edges(spark):
    docs, items = fixture(3)
    items = [x for x in items if x[0] is not None]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, _id int, _key int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.benchmark_hits(docs, items)
    kept = decontam.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    good = lambda k: not (want[k][1] > 0 and 20 * want[k][1] >= want[k][0])
    assert sorted((str(r[0]), str(r[1])) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in docs if good((i, t)))
    assert decontam.drop_contaminated(df, bench.limit(0)).count() == len(docs)
    assert decontam.find_items(df.limit(0), bench).count() == 0


def test_windows_of_the_middle_of_an_item_are_found(spark):
    item = " ".join(f"q{k}" for k in range(40))
    text = "before " + " ".join(f"q{k}" for k in range(11, 24)) + " after"
    df = spark.createDataFrame([(1, text), (2, text.replace("q15", "q99"))], "doc_id long, text string")
    got = {r["id"]: (r["n_hit"], r["items"]) for r in decontam.find_items(df, spark.createDataFrame([(4, item)], "item_id long, text string")).collect()}
    assert got == {1: (13, ["4"]), 2: (0, [])}


def test_a_text_full_of_hits_takes_little_memory():
    rng = random.Random(5)
    texts = [" ".join(f"é{rng.randint(0, 99)}" for _ in range(n)) for n in (0, 3, 5, 40, 20000)] + [None]
    words = packed.Texts(pa.chunked_array([pa.nulls(len(texts), pa.int64())]), map(decontam.words_of, texts))
    every, none = np.full(1 << decontam.FILTER_BITS - 3, 255, np.uint8), np.zeros(1 << decontam.FILTER_BITS - 3, np.uint8)
    held = pa.total_allocated_bytes()
    tracemalloc.start()
    hits = decontam._hits(words, every, [2, 5], 13)
    peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - held
    tracemalloc.stop()
    assert [len(h) for h in hits.to_pylist()] == [0, 2, 4 + 1, 39 + 36, 19999 + 19996, 0]
    for text, own in zip(texts, hits.to_pylist(), strict=True):
        for k, h in enumerate(own[:40]):
            size = 2 if k < len(text.split()) - 1 else 5
            a = max(0, h["pos"] + size - 13)
            assert (h["from"], h["around"]) == (a, text.split()[a : h["pos"] + 13])
    assert peak < 1000 * len(hits.flatten())
    assert [len(h) for h in decontam._hits(words, none, [2, 5], 13).to_pylist()] == [0] * 6
