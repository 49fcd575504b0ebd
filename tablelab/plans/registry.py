"""The query registry: every key of the build list, its Spark plan and its DuckDB oracle.

A plan is ``f(spark, sf_dir) -> DataFrame`` reading the driver's parquet tables (or
data Spark derives from them).  The oracle is ANSI SQL over the same tables, with
identical column names.  Keys without an oracle are checked on row counts only and
have a brute-force unit test instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    plan: Plan
    sql: str | None
    flagship: bool = False


_ENTRIES: dict[str, Entry] = {}


def register(key: str, sql: str | None = None, flagship: bool = False) -> Callable[[Plan], Plan]:
    def deco(fn: Plan) -> Plan:
        if key in _ENTRIES:
            raise ValueError(f"duplicate key {key}")
        _ENTRIES[key] = Entry(key, fn, sql.strip() if sql else None, flagship)
        return fn

    return deco


def entries() -> dict[str, Entry]:
    # Importing the plan modules fills the registry.
    from tablelab.plans import (  # noqa: F401
        eventlog_plans,
        io_plans,
        profile_plans,
        quality_plans,
        skew_plans,
        snapshot_plans,
        stream_plans,
        udf_plans,
    )

    return dict(_ENTRIES)


def queries() -> dict[str, Plan]:
    return {k: e.plan for k, e in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in entries().items() if e.sql}


def flagship() -> Entry:
    return next(e for e in entries().values() if e.flagship)


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Make the inputs that several plans share, so that no plan's time holds them."""
    entries()
    from tablelab.plans import eventlog_plans, io_plans, snapshot_plans, stream_plans

    eventlog_plans.tasks(spark, sf_dir)
    io_plans._audit_fixture(spark, sf_dir)
    snapshot_plans.seeded(spark, sf_dir)
    stream_plans._arrive(spark, sf_dir)
