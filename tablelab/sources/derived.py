"""Test inputs derived from the driver's tables by rules on the row id.

The driver's tables are clean and near-uniform, so defects, skew and lateness are
injected by deterministic rules that SQL can compute too.  The work of each rule
grows with the table (one output line per input row).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CSV_HEADER = "event_id,user_id,event_type"
CSV_SCHEMA = "event_id long, user_id long, event_type string"
JSON_SCHEMA = "event_id long, user_id long, event_type string"
#: Lines take turns by ``event_id % TURN``; digits that carry a number beyond 64 bits.
TURN, BEYOND = 12, "9" * 20


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _chosen(events: DataFrame, kinds: dict[int, Callable[[], Column]], good: Column) -> Column:
    """The line of each event: ``kinds`` by ``event_id % TURN``, else ``good``."""
    turn, line = F.pmod(F.col("event_id"), F.lit(TURN)), F.lit(None).cast("string")
    for at, make in kinds.items():
        line = F.when(turn == at, make()).otherwise(line)
    return F.coalesce(line, good)


def csv_lines(events: DataFrame, source: str = "events.csv", with_header: bool = True) -> DataFrame:
    """Delimited lines from ``events``, a function of the good line for some of each ``TURN`` ids.

    Defects: 3 a number beyond the type, 5 another separator, 8 a separator within a field,
    11 a quote before the whole line.  6 and 9 are good: a quoted separator, an empty value.
    A line of blanks precedes each event with ``event_id % 64 = 0``; the header is found by
    content, wherever it stands."""
    kind = F.col("event_type")
    row = lambda *fields, sep=",": F.concat_ws(sep, *fields)
    ident, user = _s("event_id"), _s("user_id")
    good = row(ident, user, kind)
    line = _chosen(events, {
        3: lambda: row(ident, F.concat(F.lit(BEYOND), user), kind),
        5: lambda: row(ident, user, kind, sep=";"),
        6: lambda: row(ident, user, F.concat(F.lit('"'), kind, F.lit(', again"'))),
        8: lambda: row(ident, user, F.substring(kind, 1, 2), F.substring(kind, 3, 99)),
        9: lambda: row(ident, F.lit(""), kind),
        11: lambda: F.concat(F.lit('"'), good),
    }, good)
    after_blanks = F.pmod(F.col("event_id"), F.lit(64)) == 0
    out = events.select(F.explode(F.when(after_blanks, F.array(F.lit("   "), line)).otherwise(F.array(line))).alias("value"))
    if with_header:
        header = events.sparkSession.createDataFrame([(CSV_HEADER,)], "value string")
        out = header.unionByName(out)
    return out.withColumn("source", F.lit(source))


def json_lines(events: DataFrame, source: str = "events.json") -> DataFrame:
    """JSON lines from ``events``, a function of the good line for some of each ``TURN`` ids.

    Defects: 2 an array in place of the object, 4 the last text cut, 7 a number beyond the
    type.  5, 9 and 10 are good: a key given twice (the last one counts), a field that the
    schema doesn't know, a null."""
    pair = lambda key, value: F.concat(F.lit(f'"{key}":'), value)
    whole = lambda *pairs: F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    quoted = F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    ident, user, kind = pair("event_id", _s("event_id")), pair("user_id", _s("user_id")), pair("event_type", quoted)
    good = whole(ident, user, kind)
    line = _chosen(events, {
        2: lambda: F.concat(F.lit("["), F.concat_ws(",", _s("event_id"), _s("user_id"), quoted), F.lit("]")),
        4: lambda: F.substring(good, F.lit(1), F.length(good) - 3),
        5: lambda: whole(ident, pair("user_id", F.lit("-1")), user, kind),
        7: lambda: whole(ident, pair("user_id", F.concat(F.lit(BEYOND), _s("user_id"))), kind),
        9: lambda: whole(pair("region", F.lit('"north"')), ident, user, kind),
        10: lambda: whole(ident, pair("user_id", F.lit("null")), kind),
    }, good)
    return events.select(line.alias("value"), F.lit(source).alias("source"))


def note_records(events: DataFrame) -> DataFrame:
    """CSV records ``event_id,user_id,note`` from ``events``, as text that may hold line breaks.

    By ``event_id % 8``: 1 a note of three lines, one of them like a record, 3 a note with
    doubled quotes and a line break, 5 a quote never closed, 6 a separator within quotes,
    else a plain word."""
    turn, ident, user, kind = F.pmod(F.col("event_id"), F.lit(8)), _s("event_id"), _s("user_id"), F.col("event_type")
    text = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    note = (
        F.when(turn == 1, text(kind, F.lit("\nseen,by,all\nend "), ident))
        .when(turn == 3, text(F.lit('said ""'), kind, F.lit('""\nthen left')))
        .when(turn == 5, F.concat(F.lit('"'), kind))
        .when(turn == 6, text(kind, F.lit(", again")))
        .otherwise(kind)
    )
    return events.select(F.concat_ws(",", ident, user, note).alias("value"))


def skewed_events(events: DataFrame) -> DataFrame:
    """``events`` with ``customer_id`` = 1 for 80% of rows (``event_id % 10 < 8``),
    else ``user_id + 2``."""
    from tablelab.sources.generate import skew_keys

    return skew_keys(events, "event_id", "user_id", "customer_id")


def task_end_lines(events: DataFrame) -> DataFrame:
    """Spark event-log lines derived from ``events``: one ``SparkListenerTaskStart``
    and one ``SparkListenerTaskEnd`` per event.  Stage = ``user_id % 10``, executor =
    ``user_id % 4``, run time = ``round(value)`` ms, a failure when ``event_type =
    'error'`` (FetchFailed for even ids, ExceptionFailure for odd ones)."""
    from tablelab.functions import ntz_to_instant

    launch = F.unix_millis(ntz_to_instant("ts"))
    run = F.round("value").cast("long")
    error = F.col("event_type") == "error"
    reason = F.when(~error, F.lit("Success")).when(F.pmod("event_id", F.lit(2)) == 0, F.lit("FetchFailed")).otherwise(
        F.lit("ExceptionFailure")
    )
    executor = F.pmod("user_id", F.lit(4)).cast("string")
    purchase = F.col("event_type") == "purchase"
    end = F.struct(
        F.lit("SparkListenerTaskEnd").alias("Event"),
        F.pmod("user_id", F.lit(10)).alias("Stage ID"),
        F.lit(0).alias("Stage Attempt ID"),
        F.lit("ResultTask").alias("Task Type"),
        F.struct(
            reason.alias("Reason"),
            F.when(reason == "ExceptionFailure", F.lit("java.lang.RuntimeException")).alias("Class Name"),
        ).alias("Task End Reason"),
        F.struct(
            F.col("event_id").alias("Task ID"),
            F.lit(0).alias("Attempt"),
            launch.alias("Launch Time"),
            (launch + run + 5).alias("Finish Time"),
            executor.alias("Executor ID"),
            F.concat(F.lit("host-"), executor).alias("Host"),
            error.alias("Failed"),
            F.lit(False).alias("Killed"),
        ).alias("Task Info"),
        F.struct(
            run.alias("Executor Run Time"),
            (run * 1000000).alias("Executor CPU Time"),
            F.pmod("event_id", F.lit(7)).alias("JVM GC Time"),
            F.when(purchase, F.col("event_id") * 1024).otherwise(F.lit(0)).alias("Memory Bytes Spilled"),
            F.when(purchase, F.col("event_id") * 512).otherwise(F.lit(0)).alias("Disk Bytes Spilled"),
            (F.col("user_id") * 1000).alias("Peak Execution Memory"),
            F.struct((F.col("event_id") * 8).alias("Bytes Read"), F.lit(1).alias("Records Read")).alias("Input Metrics"),
            F.struct(
                F.pmod("user_id", F.lit(5)).alias("Fetch Wait Time"),
                (F.col("event_id") * 10).alias("Remote Bytes Read"),
                (F.col("event_id") * 3).alias("Local Bytes Read"),
                F.pmod("event_id", F.lit(100)).alias("Total Records Read"),
            ).alias("Shuffle Read Metrics"),
            F.struct(
                (F.col("user_id") * 100).alias("Shuffle Bytes Written"), F.lit(1).alias("Shuffle Records Written")
            ).alias("Shuffle Write Metrics"),
        ).alias("Task Metrics"),
    )
    start = F.struct(
        F.lit("SparkListenerTaskStart").alias("Event"),
        F.pmod("user_id", F.lit(10)).alias("Stage ID"),
        F.struct(F.col("event_id").alias("Task ID"), launch.alias("Launch Time")).alias("Task Info"),
    )
    return events.select(F.explode(F.array(F.to_json(start), F.to_json(end))).alias("value"))
