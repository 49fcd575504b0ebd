"""Declared expectations on a table, evaluated in one aggregate.

Every row-level check contributes one ``count_if`` to a single aggregate (one scan
for all of them); key uniqueness adds one grouped aggregate per key set; schema
checks are evaluated from the schema.  Results are typed rows (label, passed,
violations, detail), never marker strings, and ``assert_all`` raises with the
failing labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_SCHEMA = "label string, passed boolean, violations long, detail string"


@dataclass(frozen=True)
class Check:
    """A named check.  ``kind`` selects how it is evaluated:

    * ``rows``: ``violation`` is a row-level boolean; passes when no row violates.
    * ``count``: ``lo``/``hi`` bound the table's row count.
    * ``unique``: ``keys`` must not repeat (null keys are ignored, as in SQL UNIQUE).
    * ``schema``: ``present`` / ``absent`` column names.
    """

    label: str
    kind: str
    violation: Column | None = None
    lo: int | None = None
    hi: int | None = None
    keys: tuple[str, ...] = ()
    present: tuple[str, ...] = ()
    absent: tuple[str, ...] = ()


def not_null(col: str, label: str | None = None) -> Check:
    return Check(label or f"{col} not null", "rows", violation=F.col(col).isNull())


def in_range(col: str, lo=None, hi=None, label: str | None = None) -> Check:
    c = F.col(col)
    v = F.lit(False)
    if lo is not None:
        v = v | (c < F.lit(lo))
    if hi is not None:
        v = v | (c > F.lit(hi))
    return Check(label or f"{col} in [{lo}, {hi}]", "rows", violation=F.coalesce(v, F.lit(False)))


def satisfies(condition: str | Column, label: str) -> Check:
    """Every row satisfies the condition (a null result counts as a violation)."""
    cond = F.expr(condition) if isinstance(condition, str) else condition
    return Check(label, "rows", violation=~F.coalesce(cond, F.lit(False)))


def row_count(lo: int | None = None, hi: int | None = None, label: str | None = None) -> Check:
    return Check(label or f"row count in [{lo}, {hi}]", "count", lo=lo, hi=hi)


def unique(keys: str | Sequence[str], label: str | None = None) -> Check:
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    return Check(label or f"{', '.join(keys)} unique", "unique", keys=keys)


def has_columns(names: Sequence[str], label: str | None = None) -> Check:
    return Check(label or f"has {', '.join(names)}", "schema", present=tuple(names))


def lacks_columns(names: Sequence[str], label: str | None = None) -> Check:
    return Check(label or f"lacks {', '.join(names)}", "schema", absent=tuple(names))


def _row(label: str, violations: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(label).alias("label"),
        (violations == 0).alias("passed"),
        violations.cast("long").alias("violations"),
        detail.alias("detail"),
    )


def expect(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``: one row per check, in the given order
    (column ``ordinal``)."""
    if not checks:
        raise ValueError("no checks")
    spark = df.sparkSession
    aggs = [F.count(F.lit(1)).alias("__rows")]
    structs = []
    for i, ch in enumerate(checks):
        if ch.kind == "rows":
            aggs.append(F.count_if(ch.violation).alias(f"__v{i}"))
            v = F.col(f"__v{i}")
            structs.append((i, _row(ch.label, v, F.concat(F.lit("violations="), v.cast("string")))))
        elif ch.kind == "count":
            rows = F.col("__rows")
            bad = F.lit(False)
            if ch.lo is not None:
                bad = bad | (rows < F.lit(ch.lo))
            if ch.hi is not None:
                bad = bad | (rows > F.lit(ch.hi))
            structs.append((i, _row(ch.label, bad.cast("long"), F.concat(F.lit("rows="), rows.cast("string")))))
        elif ch.kind not in ("unique", "schema"):
            raise ValueError(f"unknown check kind {ch.kind}")

    parts = []
    if structs:
        one = df.agg(*aggs)
        parts.append(one.select(F.inline(F.array(*[F.struct(F.lit(i).alias("ordinal"), s.alias("r")) for i, s in structs]))))
    for i, ch in enumerate(checks):
        if ch.kind == "unique":
            any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in ch.keys])
            keyed = df.where(~any_null)
            dup = (
                keyed.groupBy(*ch.keys)
                .agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1)
                .agg(F.count(F.lit(1)).alias("dup_keys"))
            )
            v = F.col("dup_keys")
            parts.append(
                dup.select(
                    F.lit(i).alias("ordinal"),
                    _row(ch.label, v, F.concat(F.lit("duplicate keys="), v.cast("string"))).alias("r"),
                )
            )
        elif ch.kind == "schema":
            cols = set(df.columns)
            missing = [c for c in ch.present if c not in cols]
            unwanted = [c for c in ch.absent if c in cols]
            wrong = missing + unwanted
            detail = "ok" if not wrong else "missing=" + ",".join(missing) + ";unexpected=" + ",".join(unwanted)
            parts.append(
                spark.range(1).select(
                    F.lit(i).alias("ordinal"), _row(ch.label, F.lit(len(wrong)), F.lit(detail)).alias("r")
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("ordinal", "r.*")


def summarize(results: DataFrame) -> DataFrame:
    """passed, failed, total over the result rows of :func:`expect`."""
    return results.agg(
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


class ExpectationError(AssertionError):
    def __init__(self, failed: list[tuple[str, str]]):
        self.failed = failed
        super().__init__("failed checks: " + "; ".join(f"{label} ({detail})" for label, detail in failed))


def assert_all(results: DataFrame) -> None:
    """Raise :class:`ExpectationError` naming every failing check (a bounded list:
    one row per declared check)."""
    failed = [(r["label"], r["detail"]) for r in results.where(~F.col("passed")).orderBy("ordinal").collect()]
    if failed:
        raise ExpectationError(failed)
