"""Language identification by a byte convolutional network.

Texts are cut into windows of a fixed number of bytes, all of them, up to the last.  The
network has an embedding of bytes, filters of several widths, the maximum of each filter
over a window, and a softmax.  It is trained here, in numpy, on a bounded sample of
labelled rows, and its weights (some tens of kilobytes) are broadcast.  A text's scores
are the mean of its windows' log probabilities, by their letters.

For prediction a filter of width w over embedded bytes is a sum of w rows of tables
(one row per byte), so windows of many texts go through it together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelab.llm.common import col, fresh

WINDOW = 192
WIDTHS = (2, 3, 4)
#: Of each width; eight 16-bit sums are one item of 16 bytes.
FILTERS = 8
DIM = 8
#: The bound of the sample: so many documents, and so many windows of each.
SAMPLE_DOCS = 3000
SAMPLE_WINDOWS = 4
EPOCHS = 6
UNKNOWN = "und"
#: Windows that go through the network together.
BATCH = 256


def _rows(table: np.ndarray) -> np.ndarray:
    """(n, FILTERS) of int16 as n items of 16 bytes, which numpy looks up one by one fast."""
    return np.ascontiguousarray(table).view(np.complex128)[:, 0]


def _top(z: np.ndarray) -> np.ndarray:
    """The maximum over axis 1, by halves."""
    while z.shape[1] > 1:
        half = (z.shape[1] + 1) // 2
        z = np.maximum(z[:, :half], z[:, -half:])
    return z[:, 0]


@dataclass(frozen=True)
class Model:
    """Languages; for each width and offset a table (256, FILTERS) of whole numbers, their
    ``scale``; filter biases; the output layer."""

    languages: tuple[str, ...]
    tables: tuple[tuple[np.ndarray, ...], ...]
    scale: float
    biases: tuple[np.ndarray, ...]
    out: np.ndarray
    bias: np.ndarray
    window: int = WINDOW

    @cached_property
    def looked_up(self) -> list[list[np.ndarray]]:
        """Tables for two bytes at a time (65,536 rows), which halve the look-ups of a filter, or for one."""
        return [
            [
                _rows((t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, -1) if j + 1 < len(t) else t[j])
                for j in range(0, len(t), 2)
            ]
            for t in self.tables
        ]

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(n, window) bytes to (n, languages)."""
        pooled, one = [], windows.astype(np.intp)
        two = one[:, :-1] << 8 | one[:, 1:]
        for tables, rows, bias in zip(self.tables, self.looked_up, self.biases, strict=True):
            n, total = windows.shape[1] - len(tables) + 1, None
            for j, table in enumerate(rows):
                at = (two if 2 * j + 1 < len(tables) else one)[:, 2 * j : 2 * j + n]
                part = table.take(at).view(np.int16).reshape(len(windows), n, FILTERS)
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(np.maximum(_top(total) / self.scale + bias, 0))
        logits = np.concatenate(pooled, axis=1) @ self.out + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def cut_windows(text: bytes, window: int = WINDOW) -> np.ndarray:
    """All windows of a text, one after another; the last is filled up with zeros."""
    n = -(-len(text) // window)
    out = np.zeros(n * window, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, window)


def letters_in(windows: np.ndarray) -> np.ndarray:
    """Bytes of each window that are part of a letter: a-z, A-Z and all beyond ASCII."""
    low = windows | 32
    return (((low >= 97) & (low <= 122)) | (windows >= 128)).sum(axis=1)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7, epochs: int = EPOCHS,
          widths: tuple[int, ...] = WIDTHS, dim: int = DIM) -> Model:
    """Fit the network by Adam on (n, window) bytes and label numbers; the same input gives the same model."""
    rng, filters = np.random.default_rng(seed), FILTERS
    size, k = windows.shape[1], len(languages)
    p: dict[str, np.ndarray] = {"E": rng.normal(0, 0.5, (256, dim)).astype(np.float32)}
    for w in widths:
        p[f"W{w}"] = rng.normal(0, (w * dim) ** -0.5, (w * dim, filters)).astype(np.float32)
        p[f"b{w}"] = np.zeros(filters, np.float32)
    p["O"] = rng.normal(0, 0.2, (filters * len(widths), k)).astype(np.float32)
    p["c"] = np.zeros(k, np.float32)
    first = {n: np.zeros_like(v) for n, v in p.items()}
    second = {n: np.zeros_like(v) for n, v in p.items()}
    # Languages count alike, however many documents each has.
    weight = (len(labels) / k / np.maximum(np.bincount(labels, minlength=k), 1)).astype(np.float32)
    step, batch = 0, 128
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for a in range(0, len(order), batch):
            x, y = windows[order[a : a + batch]], labels[order[a : a + batch]]
            n, grad = len(y), {}
            e = p["E"][x]
            pooled, tops, patches = [], [], []
            for w in widths:
                m = size - w + 1
                z = e[:, :m] @ p[f"W{w}"][:dim]
                for j in range(1, w):
                    z += e[:, j : j + m] @ p[f"W{w}"][j * dim : (j + 1) * dim]
                top = z.argmax(axis=1)
                best = np.take_along_axis(z, top[:, None], 1)[:, 0] + p[f"b{w}"]
                pooled.append(best)
                tops.append(top)
            h = np.concatenate(pooled, axis=1)
            active = np.maximum(h, 0)
            logits = active @ p["O"] + p["c"]
            logits -= logits.max(axis=1, keepdims=True)
            prob = np.exp(logits)
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(n), y] -= 1
            prob *= weight[y][:, None] / n
            grad["O"], grad["c"] = active.T @ prob, prob.sum(axis=0)
            back = (prob @ p["O"].T) * (h > 0)
            grad["E"] = np.zeros_like(p["E"])
            for i, w in enumerate(widths):
                g, top = back[:, i * filters : (i + 1) * filters], tops[i]
                grad[f"b{w}"], grad[f"W{w}"] = g.sum(axis=0), np.zeros_like(p[f"W{w}"])
                for j in range(w):
                    bytes_at = np.take_along_axis(x, top + j, 1)
                    patches = p["E"][bytes_at]  # (n, filters, dim)
                    part = slice(j * dim, (j + 1) * dim)
                    grad[f"W{w}"][part] = np.einsum("nfd,nf->df", patches, g)
                    np.add.at(grad["E"], bytes_at, g[:, :, None] * p[f"W{w}"][part].T[None])
            step += 1
            for name, v in grad.items():
                first[name] = 0.9 * first[name] + 0.1 * v
                second[name] = 0.999 * second[name] + 0.001 * v * v
                p[name] -= 0.01 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    tables = [[p["E"] @ p[f"W{w}"][j * dim : (j + 1) * dim] for j in range(w)] for w in widths]
    # Sums of a filter's rows stay within 16 bits.
    scale = 30_000 / max(sum(float(np.abs(t).max()) for t in own) for own in tables)
    whole = tuple(tuple(np.round(t * scale).astype(np.int16) for t in own) for own in tables)
    return Model(tuple(languages), whole, scale, tuple(p[f"b{w}"] for w in widths), p["O"], p["c"], size)


def sample(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, docs: int = SAMPLE_DOCS,
           windows: int = SAMPLE_WINDOWS, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows, label numbers and languages of a sample: the ``docs`` labelled rows whose ids
    hash lowest (fewer if some have no text), ``windows`` windows spread over each text.  At
    most docs * windows * window bytes reach the driver, whatever the table's size."""
    h = fresh(labelled, "_h")[0]

    def spread(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for t in texts:
                cut = cut_windows(t.encode("utf-8", "surrogatepass"), window)
                cut = cut[letters_in(cut) > 0]
                take = np.unique(np.linspace(0, len(cut) - 1, windows).astype(int)) if len(cut) else []
                out.append([cut[i].tobytes() for i in take])
            yield pd.Series(out)

    # First the hash up to which rows are taken, from ids alone; then their texts.
    known = labelled.where(col(lang_col).isNotNull()).withColumn(h, F.xxhash64(col(id_col).cast("string"), F.lit("sample")))
    upto = known.select(h).orderBy(h).limit(docs).agg(F.max(h)).first()[0]
    if upto is None:
        return np.zeros((0, window), np.uint8), np.zeros(0, int), []
    rows = (
        known.where((F.col(h) <= upto) & col(text_col).isNotNull())
        .select(col(lang_col).alias("lang"), F.pandas_udf(spread, "array<binary>")(col(text_col)).alias("w"), F.col(h).alias("h"))
        .orderBy("h", "lang", "w").limit(docs).collect()
    )
    languages = sorted({r["lang"] for r in rows if r["w"]})
    pairs = [(np.frombuffer(bytes(x), np.uint8), languages.index(r["lang"])) for r in rows for x in r["w"]]
    if not pairs:
        return np.zeros((0, window), np.uint8), np.zeros(0, int), []
    return np.stack([x for x, _ in pairs]), np.array([y for _, y in pairs]), languages


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", **kwargs) -> Model | None:
    """A model of the labelled rows; None if no row has a text with a letter and a label."""
    windows, labels, languages = sample(labelled, text_col, lang_col, id_col, **kwargs)
    return train(windows, labels, languages) if languages else None


def predict_texts(model: Model | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, its probability) of whole texts; ``und`` and 0 without a letter or a model."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if model is None:
        return out
    held, owner, size = [], [], 0
    total = np.zeros((len(texts), len(model.languages)))
    weight = np.zeros(len(texts))

    def flush() -> None:
        windows, own = np.concatenate(held), np.concatenate(owner)
        n = letters_in(windows).astype(float)
        for a in range(0, len(windows), BATCH):
            part = slice(a, a + BATCH)
            np.add.at(total, own[part], model.log_probabilities(windows[part]) * n[part, None])
        np.add.at(weight, own, n)
        held.clear()
        owner.clear()

    known = []
    for i, t in enumerate(texts):
        if t is None or not any(map(str.isalpha, t)):
            continue
        known.append(i)
        cut = cut_windows(t.encode("utf-8", "surrogatepass"), model.window)
        held.append(cut)
        owner.append(np.full(len(cut), i))
        size += len(cut)
        if size >= BATCH:
            flush()
            size = 0
    if held:
        flush()
    for i in known:
        score = total[i] / max(weight[i], 1)
        prob = np.exp(score - score.max())
        prob /= prob.sum()
        out[i] = (model.languages[int(score.argmax())], float(prob.max()))
    return out


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` with the language of each whole text and its probability.

    Null texts and texts without a letter are ``und`` with score 0; repeated rows are
    alike.  Columns of the result's names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(predict_texts(shared.value, list(texts)), columns=["lang", "score"])

    docs = docs.drop(lang_col, score_col)
    held = fresh(docs, "_lang")[0]
    found = docs.withColumn(held, F.pandas_udf(run, "lang string, score double")(col(text_col)))
    return found.select(*[col(c) for c in docs.columns], col(held)["lang"].alias(lang_col), col(held)["score"].alias(score_col))


def held_out(id_col: Column, fold: int = 0, folds: int = 5) -> Column:
    """Whether CRC-32 of the id as text falls into the fold; a null id is in none."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))
