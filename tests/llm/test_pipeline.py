"""The pipeline against the plain Python versions of its stages, and its edges."""

import duckdb

import corpus_pipeline
from tablelab.llm import mixing
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_quality_rules import verdicts

COLUMNS = "doc_id, text, lang, source, n_chars"


def plain(docs, items):
    """[(doc_id, text, lang, source, n_chars)] to the mix's (doc_id, text, n_chars, copy)."""
    docs = [d for d, (_, ok) in zip(docs, verdicts([(d[1], d[2], d[3]) for d in docs]), strict=True) if ok]
    found = brute.classes([d[:2] for d in docs], percent=80, shingle=5)
    docs = [d for d in docs if found[d[0]][1] == d[0]]
    left = {i: (n, w) for i, n, w in brute.kept_words([d[:2] for d in docs])}
    changed = []
    for i, text, lang, source, _ in docs:
        n, w = left[i]
        if w or not n:
            text = text if len(w) == n else " ".join(w)
            changed.append((i, text, lang, source, len(text)))
    hits = brute.benchmark_hits([d[:2] for d in changed], items)
    docs = [d for d in changed if not (hits[d[:2]][1] > 0 and 20 * hits[d[:2]][1] >= hits[d[:2]][0])]
    sizes = {}
    for _, text, _, source, _ in docs:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    target, out = brute.targets(sizes), []
    for i, text, _, source, n in docs:
        rate = target[source] / sizes[source] if sizes[source] else 0
        copies = int(rate + 1e-12) + (brute.draw(i, mixing.SEED) < rate - int(rate + 1e-12))
        out += [(i, text, n, k) for k in range(copies)]
    return sorted(out)


def test_against_plain_stages(spark):
    docs = duckdb.sql(f"select {COLUMNS} from '{SF_SMALL}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF_SMALL}/benchmark.parquet'").fetchall()
    got = sorted((r["doc_id"], r["text"], r["n_chars"], r["copy"]) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == plain(docs, items)
    assert {i for i, *_ in got} < {d[0] for d in docs}


def test_stages_keep_the_columns_and_take_nasty_rows(spark, tmp_path):
    text = "\n".join(f"some words of line {k} that differ from all the others x{k} y{k} z{k}" for k in range(9))
    rows = [(1, text, "en", "a", 5, 1, "t"), (1, text, "en", "a", 5, 1, "t"), (2, None, None, None, None, None, None), (3, "", "en", "a", 0, 2, "t"),
            (4, text + " tail", "en", None, 5, 3, "t"), (None, "q " * 40_000, "de", "b", 5, 4, None), (6, text.upper() * 2, None, "b", 5, 4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copy int, kept string")
    for docs in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF_SMALL).columns == df.columns, name
            docs = stage(spark, docs, SF_SMALL)
        mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
        assert mixed.columns == [*df.columns, "_copy"]
        mixed.count()


def test_stages_in_the_agreed_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram join", "substring dedup", "decontamination", "mixing"]
