"""Allow and block rules for urls, found by hashed host-suffix and path-prefix expressions.

A rule is a host and the beginning of a path.  It fits a url whose host is the rule's or
below it and whose path begins with the rule's.  Every distinct host and path is expanded
into expressions: the last labels of the host and the first characters of the path, for
the label counts and lengths that rules have.  Expressions and rules meet in an
equi-join on the first four bytes of their SHA-256; the full digests confirm, and of the
rules confirmed for a url the most specific one decides.

The expressions are made distinct before they meet the rules, so one found in every url
(``com/``) is one row.  Confirmed rules go back to the expressions, and verdicts to the
rows, by joins whose keys are unique on the smaller side: adaptive execution may
broadcast that side or split a hot key on the other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelab.llm.common import col, fresh, settled

#: The rules of the registered query (fixed values): verdict, host, path.
EXAMPLE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DEFAULT = "allow"
PREFIX_BYTES = 4


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def _lower(value: Column) -> Column:
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _digest(host: Column, path: Column) -> Column:
    # A host has no slash and a path starts with one or is empty: the two can't run together.
    return F.unhex(F.sha2(F.concat(host, path).cast("binary"), 256))


def hashed_rules(rules: DataFrame) -> DataFrame:
    """``(digest, prefix, rank, verdict, rule)``, one row for each host and path; ``block`` wins over ``allow``.

    Rules whose host, path or verdict is null, whose host has a slash or whose path is
    neither empty nor starts with one, fit no url and are left out.  Hosts are lower-cased.
    """
    valid = F.col("host").isNotNull() & F.col("verdict").isin("allow", "block") & (F.instr("host", "/") == 0)
    valid &= (F.col("path") == "") | F.startswith("path", F.lit("/"))
    one = rules.select("verdict", _lower(F.col("host")).alias("host"), "path").where(valid).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("host"), F.col("path"))
    return one.select(
        digest.alias("digest"), F.substring(digest, 1, PREFIX_BYTES).alias("prefix"), "verdict",
        F.struct(F.length("host").alias("host_chars"), F.length("path").alias("path_chars")).alias("rank"),
        F.concat("host", "path").alias("rule"), _labels(F.col("host")).alias("labels"), F.length("path").alias("chars"),
    )


def expressions(places: DataFrame, shapes: DataFrame) -> DataFrame:
    """``(host, path)`` to ``(host, path, digest, prefix)``: a row for every shape ``(labels, chars)`` that fits.

    ``shapes`` is as short as rules' hosts and paths are: at most labels times characters
    of the longest, whatever the number of rules or urls.
    """
    pairs = [F.struct(F.lit(r["labels"]).alias("labels"), F.lit(r["chars"]).alias("chars")) for r in shapes.collect()]
    known = F.array(*pairs) if pairs else F.array().cast("array<struct<labels:int,chars:int>>")
    fits = F.filter(known, lambda s: (s["labels"] <= _labels(F.col("host"))) & (s["chars"] <= F.length("path")))
    each = places.select("host", "path", F.explode(fits).alias("s"))
    suffix = F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("s.labels"))
    digest = _digest(suffix, F.substring(F.col("path"), F.lit(1), F.col("s.chars")))
    return each.select("host", "path", digest.alias("digest")).withColumn("prefix", F.substring("digest", 1, PREFIX_BYTES))


def judge(places: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``(host, path)`` to ``(host, path, rule, verdict)``, a row for each that a rule fits.

    The longest host wins, then the longest path.
    """
    hashed = settled(hashed_rules(rules), "url-rules")
    found = expressions(places, hashed.select("labels", "chars").distinct())
    seen = found.select("digest", "prefix").distinct().withColumnRenamed("digest", "full")
    confirmed = seen.join(hashed, "prefix").where(F.col("full") == F.col("digest"))
    confirmed = settled(confirmed.select("digest", "rank", "verdict", "rule"), "url-rules-met")
    best = F.max_by(F.struct("rule", "verdict"), F.col("rank")).alias("best")
    return found.join(confirmed, "digest").groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def filter_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", out_col: str = "judged", default: str = DEFAULT) -> DataFrame:
    """All rows of ``df`` with ``judged``: struct(host, path, rule, verdict).

    ``rules`` has columns verdict (allow or block), host, path.  Without a rule, ``rule``
    is null and the verdict ``default``; so it is for a null url or one without ``://``,
    whose host and path are empty.  Ports, user names and white space stay in the host;
    a path is compared as written.  Long urls cost their own length for each shape of a
    rule.  Repeated rows stay repeated; ``judged`` takes another name where ``df`` has one
    like it (``_judged``).  An empty table gives no rows, an empty rule set the default.
    """
    host, path, out = fresh(df, "host", "path", out_col)
    placed = df.withColumns({host: host_of(col(url_col)), path: path_of(col(url_col))})
    places = settled(placed.select(col(host).alias("host"), col(path).alias("path")).distinct(), "url-places")
    names = fresh(placed, "_host", "_path", "_rule", "_verdict")
    verdicts = settled(judge(places, rules), "url-verdicts").toDF(*names)
    joined = placed.join(verdicts, (col(host) == col(names[0])) & (col(path) == col(names[1])), "left")
    judged = F.struct(
        col(host).alias("host"), col(path).alias("path"), col(names[2]).alias("rule"),
        F.coalesce(col(names[3]), F.lit(default)).alias("verdict"),
    )
    return joined.select(*[col(c) for c in df.columns], judged.alias(out))
