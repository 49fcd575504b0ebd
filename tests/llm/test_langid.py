import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelab.llm import langid
from tests.conftest import SF_ORACLE


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    return langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").where(langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = langid.predict(docs, model).collect()
    assert len(rows) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_tables_agree_with_the_filters(model):
    """Look-ups of byte pairs give the sums of single bytes' rows."""
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (20, model.window)).astype(np.uint8)
    pooled = []
    for tables, bias in zip(model.tables, model.biases, strict=True):
        n = model.window - len(tables) + 1
        z = sum(t[windows[:, j : j + n]].astype(np.int64) for j, t in enumerate(tables))
        pooled.append(np.maximum(z.max(axis=1) / model.scale + bias, 0))
    logits = np.concatenate(pooled, axis=1) @ model.out + model.bias
    want = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    assert np.allclose(model.log_probabilities(windows), want, atol=1e-5)


def test_same_input_same_model(spark, model):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").repartition(5)
    again = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    assert all(np.array_equal(a, b) for x, y in zip(model.tables, again.tables, strict=True) for a, b in zip(x, y, strict=True))


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the and of the with that " * 4000), (4, "der die und " * 30), (None, "é")]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, SCORE int, lang_pred string")
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in langid.predict(df.drop("SCORE"), model).collect()}
    assert [got[r] for r in rows[:3]] == [("und", 0.0)] * 3
    assert all(got[r][0] in model.languages for r in rows[3:])
    assert langid.predict(df.limit(0), model).count() == 0


def test_no_labels(spark):
    df = spark.createDataFrame([(1, "text", None), (2, None, "en"), (3, "12", "en")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert model is None
    assert [r["lang_pred"] for r in langid.predict(df, model).collect()] == ["und"] * 3


def test_whole_text_counts():
    """The windows cover every byte of a text."""
    text = bytes(range(1, 256)) * 5
    cut = langid.cut_windows(text, 64)
    assert cut.tobytes()[: len(text)] == text and cut.size - len(text) < 64
