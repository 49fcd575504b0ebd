import random
from collections import Counter

import duckdb

from tablelab.llm import quality
from tests.conftest import SF_ORACLE
from tests.llm import brute


def step(v):
    shift = max(v.bit_length() - 6, 0)
    return shift * 32 + (v >> shift)


def value(s):
    shift = max(s // 32 - 1, 0)
    return (s - shift * 32) << shift


def verdicts(docs, reach=quality.REACH, min_group=quality.MIN_GROUP):
    """[(text, lang, source)] to [(base failed, kept)], by plain counting."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    found = [dict(zip(names, brute.features(t), strict=True)) for t, _, _ in docs]
    measure = lambda f, m: f[quality.MEASURES[m][0]] * quality.SCALE // f[quality.MEASURES[m][1]] if f[quality.MEASURES[m][1]] else 0
    steps = {}
    for (_, lang, source), f in zip(docs, found, strict=True):
        if f["n_words"]:
            for m in quality.MEASURES:
                for key in ((lang, source), (lang,), ()):
                    steps.setdefault((key, m), Counter())[step(measure(f, m))] += 1

    def fence(key, m):
        count = steps[key, m]
        n, out = sum(count.values()), []
        for q in (0.25, 0.5, 0.75):
            upto = 0
            for s in sorted(count):
                upto += count[s]
                if upto >= q * n:
                    out.append(value(s))
                    break
        return out

    rows = []
    for (_, lang, source), f in zip(docs, found, strict=True):
        failed = f["n_words"] < 50 or 100 * f["n_repeat_words"] > 50 * f["n_words"]
        ok = not failed
        for m, (_, _, low, high, gap) in quality.MEASURES.items():
            if not f["n_words"]:
                break
            key = next((k for k in ((lang, source), (lang,)) if sum(steps[k, m].values()) >= min_group), ())
            q1, mid, q3 = fence(key, m)
            v = measure(f, m)
            ok &= not (low and v < min(q1 - reach * (q3 - q1), mid - gap)) and not (high and v > max(q3 + reach * (q3 - q1), mid + gap))
        rows.append((failed, ok))
    return rows


def test_features_against_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a b c a b c", "x y z", "a b"]
    for _ in range(300):
        n = rng.randint(0, 80)
        texts.append("".join(rng.choice(["a", "b", "c ", " ", "\n", "#", "|", "é", "\t", "ab cd ef ", "\r", "\v"]) for _ in range(n)))
    for t in texts:
        assert quality.text_features(t) == brute.features(t), t


def test_many_distinct_words_take_the_exact_path(monkeypatch):
    words = [f"w{k % 1_100_000}".encode() for k in range(1_100_005)]
    assert quality.repeated_words(words) == 10


def test_sketch_steps():
    for v in [*range(200), 1000, 12345, 10**6, 10**9 + 7]:
        s = step(v)
        assert value(s) <= v <= value(s) * (1 + 1 / 16) + 1 and value(s + 1) > v


def test_against_plain_counting(spark):
    rng = random.Random(5)
    docs = []
    for _ in range(500):
        w = ["w" * rng.randint(1, 9) + rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(0, 150))]
        if rng.random() < 0.15:
            w = [x + rng.choice(["***", "###"]) for x in w]
        if rng.random() < 0.1:
            w = [x for x in w for _ in range(3)]
        lines = [" ".join(w[k : k + 9]) for k in range(0, len(w), 9)]
        if rng.random() < 0.1:
            lines = [x for x in lines for _ in range(3)]
        docs.append(("\n".join(lines), rng.choice(["en", "en", "en", "de", None]), rng.choice(["hot", "hot", "hot", "b", None])))
    docs += [(None, "en", "hot"), ("", "xx", "yy"), ("one two", "xx", None), (docs[0][0], "en", "hot"), ("word " * 30_000, "en", "hot")]
    rows = [(k, *d, "x", 1) for k, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, limits string, _row int")
    want = verdicts(docs)
    out = quality.filter_quality(df)
    assert out.columns == df.columns
    kept = {r["doc_id"] for r in out.collect()}
    assert kept == {k for k, (_, ok) in enumerate(want) if ok}
    assert 0 < len(kept) < len(docs)
    assert quality.filter_quality(df.limit(0)).count() == 0


def test_labels(spark):
    """On labelled documents: junk goes, clean documents of 50 words or more stay."""
    rows = duckdb.sql(
        f"select d.doc_id, quality from '{SF_ORACLE}/documents.parquet' d join '{SF_ORACLE}/labels.parquet' using (doc_id)"
    ).fetchall()
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    kept = {r["doc_id"] for r in quality.filter_quality(docs).select("doc_id").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    good = [i for i, q in rows if q == 1 and len(brute.words(texts[i])) >= 50]
    assert sum(i in kept for i in good) >= 0.98 * len(good)
    bad = [i for i, q in rows if q == 0]
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)
