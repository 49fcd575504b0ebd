"""Quality rules with thresholds learnt per language and source.

Measures of a text (word length, symbols, repeated lines, repeated words) are ratios,
taken as whole parts of 10,000.  Each (language, source, measure) has a quantile sketch:
a histogram with 32 steps per power of two, at most about 1,000 counters, merged by
adding counts.  Its quantiles are those of the data within 1/32.  Thresholds are outer
fences, quartiles plus ``reach`` times their distance, so they follow each group's own
spread instead of cutting a fixed share.  Groups with few documents use the merged
sketch of their language, then that of the whole corpus.  Documents join their group's
fences and are judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelab.llm.common import col, fresh, settled

SYMBOLS = "#*$%&|<>"
SCALE = 10_000
REACH = 4.0
MIN_GROUP = 100
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"

#: measure: (numerator, denominator, is a low value bad, is a high value bad, least distance
#: of a fence from the median in parts of SCALE)
MEASURES = {
    "word_length": ("word_chars", "n_words", True, True, 15_000),
    "symbols": ("n_symbols", "n_words", False, True, 1_000),
    "dup_lines": ("n_dup_lines", "n_lines", False, True, 4_000),
    "repeat_words": ("n_repeat_words", "n_words", False, True, 3_000),
}


def text_features(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The counts of ``FEATURES`` for a text; null has none of anything.

    A line is what stands between two \\n, if it has a word; a repeated word is one in a
    window of three words that occurs twice or more in the text, the first included.
    """
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a three-word window that the text has twice or more; exact."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    v = len(number)
    if v >= 1 << 20:  # pairs are numbered anew, so that a window still fits 63 bits
        _, pairs = np.unique(ids[:-2] * v + ids[1:-1], return_inverse=True)
        keys = pairs * v + ids[2:]
    else:
        keys = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    if v == n:
        return 0
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def _features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in FEATURES.split(", ")]
    for texts in batches:
        yield pd.DataFrame([text_features(t) for t in texts], columns=names, dtype="int64")


def features(text: Column) -> Column:
    """``FEATURES`` of whole texts, as a struct.

    Declared as not deterministic, so that a filter on it doesn't count the text again."""
    return F.pandas_udf(_features, FEATURES).asNondeterministic()(text)


def _measure(f: Column, name: str) -> Column:
    top, bottom = MEASURES[name][:2]
    return F.when(f[bottom] > 0, F.floor(f[top] * SCALE / f[bottom]).cast("long")).otherwise(0)


def sketch_bin(value: Column) -> Column:
    """The sketch's step for a whole number of 0 or more: exact below 32, then 32 steps per power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (shift * 32 + F.floor(value / F.pow(F.lit(2.0), shift))).cast("int")


def bin_value(step: Column) -> Column:
    """The least value in a step."""
    shift = F.greatest(F.floor(step / 32).cast("int") - 1, F.lit(0))
    return ((step - shift * 32) * F.pow(F.lit(2.0), shift)).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """``(lang, source, f)`` to ``(lang, source, measure, step, n)``: counters, summed before the shuffle.

    Documents without words carry no measure and are left out.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), sketch_bin(_measure(F.col("f"), m)).alias("step")) for m in MEASURES]))
    return (
        measured.where("f.n_words > 0").select("lang", "source", pairs.alias("p"))
        .groupBy("lang", "source", "p.measure", "p.step").agg(F.count("*").alias("n"))
    )


def quantiles(counters: DataFrame, keys: list[str], qs: dict[str, float]) -> DataFrame:
    """Quantiles of merged sketches: ``(*keys, n, *qs)``; a group has at most one row per step here."""
    merged = counters.groupBy(*keys, "step").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys)
    upto = F.sum("n").over(group.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = merged.withColumn("upto", upto).withColumn("all", F.sum("n").over(group))
    found = [F.min(F.when(F.col("upto") >= F.lit(q) * F.col("all"), F.col("step"))).alias(k) for k, q in qs.items()]
    return ranked.groupBy(*keys).agg(F.max("all").alias("n"), *found).select(
        *keys, "n", *[bin_value(F.col(k)).alias(k) for k in qs]
    )


def fences(counters: DataFrame, reach: float = REACH, min_group: int = MIN_GROUP) -> DataFrame:
    """``(lang, source, limits)``: for each measure the least and greatest value that passes.

    Both quartile distances are widened to a least distance, as ratios of a group may
    all be equal.  Language and source may be null and are groups like others.
    """
    qs = {"q1": 0.25, "mid": 0.5, "q3": 0.75}
    own = quantiles(counters, ["lang", "source", "measure"], qs)
    by_lang = quantiles(counters, ["lang", "measure"], qs)
    whole = quantiles(counters, ["measure"], qs)
    def packed(name):
        return F.struct(*[F.col(c) for c in ("n", *qs)]).alias(name)
    table = (
        own.select("lang", "source", "measure", packed("a"))
        .join(by_lang.select(F.col("lang").alias("lang2"), F.col("measure").alias("m2"), packed("b")),
              F.col("lang").eqNullSafe(F.col("lang2")) & (F.col("measure") == F.col("m2")), "left")
        .join(whole.select(F.col("measure").alias("m3"), packed("c")), F.col("measure") == F.col("m3"), "left")
    )
    use = F.when(F.col("a.n") >= min_group, F.col("a")).when(F.col("b.n") >= min_group, F.col("b")).otherwise(F.col("c"))
    table = table.select("lang", "source", "measure", use.alias("q"))
    def pick(values: dict[str, float]) -> Column:
        out = F.lit(None).cast("double")
        for m, v in values.items():
            out = F.when(F.col("measure") == m, F.lit(float(v))).otherwise(out)
        return out
    gap = pick({m: x[4] for m, x in MEASURES.items()})
    spread = (F.col("q.q3") - F.col("q.q1")) * F.lit(reach)
    low = F.least(F.col("q.q1") - spread, F.col("q.mid") - gap)
    high = F.greatest(F.col("q.q3") + spread, F.col("q.mid") + gap)
    limits = [F.max(F.when(F.col("measure") == m, F.struct(low.alias("low"), high.alias("high")))).alias(m) for m in MEASURES]
    return table.groupBy("lang", "source").agg(*limits).select("lang", "source", F.struct(*MEASURES).alias("limits"))


def base_failed(f: Column) -> Column:
    """Fewer than 50 words, or more than half of the words repeated."""
    return (f["n_words"] < 50) | (100 * f["n_repeat_words"] > 50 * f["n_words"])


def passes(f: Column, limits: Column) -> Column:
    """The verdict of the fences; a document whose group has none has no words and passes none."""
    ok = limits.isNotNull()
    for m, (_, _, low, high, _) in MEASURES.items():
        value = _measure(f, m)
        if low:
            ok = ok & (value >= limits[m]["low"])
        if high:
            ok = ok & (value <= limits[m]["high"])
    return ok


def judge(measured: DataFrame, reach: float = REACH, min_group: int = MIN_GROUP,
          counted: DataFrame | None = None) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to rows with ``lang``, ``source`` and features ``f``.

    ``counted`` (default: the rows themselves) are those the sketches are built from.
    The join is on two null-safe keys; the engine broadcasts the fences if they are
    measured as small, else it splits the partitions of a hot source.
    """
    table = fences(sketches(measured if counted is None else counted), reach, min_group)
    table = settled(table.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "limits"), "fences")
    joined = measured.join(
        table, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    ).drop("_lang", "_source")
    return joined.withColumn("base_failed", base_failed(F.col("f"))).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(passes(F.col("f"), F.col("limits")), F.lit(False))
    )


def filter_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                   reach: float = REACH, min_group: int = MIN_GROUP) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged.

    Null and empty texts go; repeated rows are judged alike and all stay or go.
    """
    row = fresh(docs, "_row")[0]
    held = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias(row), col(lang_col).alias("lang"), col(source_col).alias("source"),
        features(col(text_col)).alias("f"),
    )
    counted = docs.select(col(lang_col).alias("lang"), col(source_col).alias("source"), features(col(text_col)).alias("f"))
    kept = judge(held, reach, min_group, counted).where("kept")
    return kept.select(*[F.col(row)[c].alias(c) for c in docs.columns])
