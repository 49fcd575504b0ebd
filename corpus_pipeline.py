"""From raw documents to a training mix, each stage a Spark job over all that is left.

``STAGES`` is run in order: quality rules, n-gram join, substring dedup, benchmark
decontamination, mixing.  Each stage's rows are written as Parquet in the shared folder
and read again by the next one; all but the last return the columns of documents, whose
extra columns, if any, go through.

Documents are identified by ``doc_id``.  Null and empty texts go in the first stage (fewer
than 50 words).  Rows of one ``doc_id`` are one document to the near-duplicate stage.  An
empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.llm import decontam, mixing, ngram_join, quality, substring
from tablelab.session import scratch_dir, table

#: Sketch fences, inverted lists and window hashes have no SQL form at this size; the
#: operators' own tests compare them with brute force and SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their group's fences reject go."""
    return quality.filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked by n-gram similarity the one with the least id stays.

    The stage is operator 10 with the values of near-duplicate stages: documents link at a
    Jaccard similarity of 0.8 on five-word shingles.  (Its query has three words at 0.9.)
    """
    return ngram_join.keep_one(docs, shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that an earlier document already has go; ``n_chars`` follows the text."""
    kept = substring.remove_repeats(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with the benchmark go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; copies are numbered from 0."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: a row for each copy of each document taken."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_dir(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
