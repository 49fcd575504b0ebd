import random

import pytest

from tablelab.llm import packed, substring
from tests.llm import brute


@pytest.fixture(params=[2 << 20, 600])
def small_groups(request, monkeypatch):
    monkeypatch.setattr(packed, "GROUP_BYTES", request.param)
    monkeypatch.setattr(packed, "BUCKET_BYTES", request.param)


def fixture_docs():
    rng = random.Random(11)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 80))) for _ in range(25)]
    docs = []
    for i in range(80):
        parts = [rng.choice(base)]
        if rng.random() < 0.6:
            w = rng.choice(base).split()
            a = rng.randint(0, max(0, len(w) - 20))
            parts.append(" ".join(w[a : a + rng.randint(8, 30)]))
        rng.shuffle(parts)
        docs.append((i * 7 % 83, "\t\n".join(parts)))
    docs += [(500, None), (501, ""), (502, " \n "), (503, base[3] + " x　y " + base[4]), (-5, base[5]), (600, " ".join(base) * 20)]
    return docs


def test_against_brute_force(spark, small_groups):
    docs = fixture_docs()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, kept string, _group int")
    got = {r["doc_id"]: r for r in substring.mark_repeats(df).collect()}
    want = brute.kept_words(docs)
    assert len(got) == len(want)
    assert any(len(k) < n for _, n, k in want)
    for i, n, kept in want:
        r = got[i]
        assert (r["n_words"], r["kept"]) == (n, " ".join(kept)), i
        assert sum(s["end"] - s["start"] for s in r["removed"]) == n - len(kept)
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:], strict=False))


def test_equal_and_null_ids(spark, small_groups):
    text = " ".join(f"w{k}" for k in range(20))
    df = spark.createDataFrame([(3, text), (3, text), (3, text + " more"), (None, text), (None, text + " z")], "doc_id long, text string")
    got = [(r["doc_id"], r["kept"]) for r in substring.mark_repeats(df).collect()]
    assert sorted(k for i, k in got if i == 3) == [text, text, text + " more"]
    assert sorted(k for i, k in got if i is None) == ["", "z"]


def test_large_group_of_copies_and_pipeline_form(spark, small_groups):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(k, text if k % 2 else text + f" tail{k}", k, "n") for k in range(300)] + [(999, "short text", 1, "n"), (1000, None, 2, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, removed string")
    out = substring.remove_repeats(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got.pop(0) == text + " tail0" and got.pop(999) == "short text" and got.pop(1000, 1) is None
    assert got == {k: f"tail{k}" for k in range(2, 300, 2)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring.mark_repeats(df).count() == 0
