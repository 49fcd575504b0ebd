"""Mixing sources to target weights, with DataFrame functions only.

1. Words are counted per document and summed per source (partial sums before the
   shuffle, so a source with a third of the corpus costs no more than any other).
2. The table of sources, one row each, gets targets: ``target = min(cap * size,
   level * weight)`` with the one ``level`` at which all targets add up to the size of
   the corpus.  This is where resharing the excess of capped sources by weight ends.
3. A document is emitted ``floor(rate)`` times, ``rate = target / size`` of its source,
   and once more if a hash of seed and id falls below the fraction.

The result depends on ids, sources and word counts alone: any rerun or other
partitioning gives the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablelab.llm.common import col, fresh, n_words, settled

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """``(source, source_size)``, a row per source, to ``(source, source_size, weight, target)``.

    Sources in code-point order, null last, take ``weights`` in turn.  An empty table
    stays empty; if all sizes are 0 so are the targets.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    # Sources that fill up first come first; before[k] is what the first k take.
    by_fill = Window.orderBy("_fill", F.col("source").asc_nulls_last())
    upto = by_fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w = F.array(*[F.lit(int(x)) for x in weights])
    ranked = (
        sizes.withColumn("weight", F.element_at(w, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("_cap", F.col("source_size") * max_repeat)
        .withColumn("_fill", F.col("_cap") / F.col("weight"))
        .withColumn("_total", F.sum("source_size").over(every))
        .withColumn("_weights", F.sum("weight").over(every))
        .withColumn("_left", F.col("_total") - F.sum("_cap").over(upto) + F.col("_cap"))
        .withColumn("_open", F.col("_weights") - F.sum("weight").over(upto) + F.col("weight"))
        .withColumn("_level", F.col("_left") / F.col("_open"))
        .withColumn("_k", F.row_number().over(by_fill))
    )
    # Full sources come first; the level is that of the first source that isn't full at it.
    first = F.min(F.when(F.col("_level") <= F.col("_fill"), F.struct("_k", "_level"))).over(every)
    full = F.col("_cap").cast("double")
    target = F.when(first.isNull() | (F.col("_k") < first["_k"]), full).otherwise(
        F.least(first["_level"] * F.col("weight"), full)
    )
    return ranked.withColumn("target", target).select("source", "source_size", "weight", "target")


def draw(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) from seed and id: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: str = SEED,
    out_col: str = "mix",
) -> DataFrame:
    """All rows of ``docs`` with ``mix``: struct(size, source_size, target, copies).

    A null or wordless text has size 0; the null source is a source.  Equal ids draw
    alike, so repeated rows are taken equally often; a null id draws as the empty one.
    Columns of ``docs`` may have any names; where one is named ``mix``, the struct is ``_mix``.
    """
    size, key, isnull, told, out_col = fresh(docs, "_mix_size", "_mix_source", "_mix_null", "_mix_target", out_col)
    sized = docs.withColumn(size, n_words(col(text_col)))
    totals = (
        sized.groupBy(col(source_col).alias("source")).agg(F.sum(col(size)).alias("source_size"))
    )
    # A written table of sources: the engine broadcasts it if it is small, and otherwise
    # joins by sort and merge, splitting skewed partitions.
    targets = settled(source_targets(totals, weights, max_repeat), "targets").select(
        F.coalesce("source", F.lit("")).alias(key),
        F.isnull("source").alias(isnull),
        F.struct("source_size", "target").alias(told),
    )
    joined = sized.withColumn(key, F.coalesce(col(source_col), F.lit(""))).withColumn(isnull, F.isnull(col(source_col)))
    joined = joined.join(targets, [key, isnull], "left")
    t = col(told)
    rate = F.when(t["source_size"] > 0, t["target"] / t["source_size"]).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(draw(col(id_col), seed) < rate - F.floor(rate), 1).otherwise(0)
    mix = F.struct(
        col(size).alias("size"), t["source_size"].alias("source_size"), t["target"].alias("target"),
        copies.cast("long").alias("copies"),
    )
    return joined.select(*[col(c) for c in docs.columns], mix.alias(out_col))


def mix(docs: DataFrame, copy_col: str = "copy", **kwargs) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, copies numbered from 0.

    All columns of ``docs`` go through, whatever their names."""
    copy_col, plan_col = fresh(docs, copy_col, kwargs.pop("out_col", "mix"))
    copies = col(plan_col)["copies"]
    planned = plan_mix(docs, out_col=plan_col, **kwargs)
    return planned.where(copies > 0).select(
        *[col(c) for c in docs.columns], F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))).alias(copy_col)
    )
