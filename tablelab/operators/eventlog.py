"""Analytics over the typed task table of :func:`tablelab.sources.eventlog.task_metrics`.

Every report is a grouped aggregate (partial + final), so it scales with the
number of tasks; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STAGE_KEYS = ["app", "stage_id", "stage_attempt"]
SKEW_FACTOR = 2.0  # a stage whose slowest task takes > 2x the median is skewed


def _stage_values(tasks: DataFrame, metric: str, exact: bool, sums: Sequence[str] = ()) -> DataFrame:
    """Per stage: tasks, median_ms, p95_ms and max_ms of ``metric``, and the ``sums``.

    Percentiles are values of the data, the least one that enough tasks don't exceed; null
    values count for nothing.  Exact ones count tasks by value first, so a stage takes a row
    for each distinct value, in a sort that spills.  Others come from a sketch of bounded size.
    """
    if not exact:
        m = F.col(metric).cast("double")
        return tasks.groupBy(*STAGE_KEYS).agg(
            F.count(F.lit(1)).alias("tasks"),
            F.percentile_approx(m, 0.5, 10000).cast("double").alias("median_ms"),
            F.percentile_approx(m, 0.95, 10000).cast("double").alias("p95_ms"),
            F.max(metric).alias("max_ms"), *[F.sum(c).alias(c) for c in sums],
        )
    stage = Window.partitionBy(*STAGE_KEYS)
    known = F.when(F.col("_value").isNotNull(), F.col("_n"))
    counted = (
        tasks.groupBy(*STAGE_KEYS, F.col(metric).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in sums])
        .withColumn("_upto", F.sum(known).over(stage.orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_all", F.sum(known).over(stage))
    )
    reached = lambda percent: F.min(F.when(100 * F.col("_upto") >= percent * F.col("_all"), F.col("_value"))).cast("double")
    return counted.groupBy(*STAGE_KEYS).agg(
        F.sum("_n").alias("tasks"), reached(50).alias("median_ms"), reached(95).alias("p95_ms"), F.max("_value").alias("max_ms"),
        *[F.sum(c).alias(c) for c in sums],
    )


def stage_skew(tasks: DataFrame, factor: float = SKEW_FACTOR, exact: bool = True, metric: str = "run_ms") -> DataFrame:
    """Per stage: tasks, median, p95, max of ``metric``, max / median, skewed.

    Percentiles are values of the data.  With ``exact`` off they are approximate: from a
    sketch, exact only for stages of up to about 10,000 tasks, so that ``skewed`` may be
    wrong near the factor.
    """
    g = _stage_values(tasks, metric, exact)
    ratio = F.when(F.col("median_ms") > 0, F.col("max_ms") / F.col("median_ms"))
    return g.select(
        *STAGE_KEYS, "tasks", "median_ms", "p95_ms", "max_ms", ratio.alias("max_over_median"),
        F.coalesce(ratio > F.lit(factor), F.col("max_ms") > 0).alias("skewed"),
    )


def stage_memory(tasks: DataFrame) -> DataFrame:
    """Per stage: spilled bytes (memory, disk), GC ms, run ms and GC share of run time."""
    g = tasks.groupBy(*STAGE_KEYS).agg(
        F.sum("memory_spilled").alias("memory_spilled"),
        F.sum("disk_spilled").alias("disk_spilled"),
        F.sum("gc_ms").alias("gc_ms"),
        F.sum("run_ms").alias("run_ms"),
    )
    return g.withColumn("gc_share", F.when(F.col("run_ms") > 0, F.col("gc_ms") / F.col("run_ms")))


def failures(tasks: DataFrame) -> DataFrame:
    """Failed tasks by reason class and executor: app, reason, executor_id, n."""
    return (
        tasks.where(F.col("failed"))
        .groupBy("app", "reason", "executor_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def executor_use(tasks: DataFrame, slots: int = 1) -> DataFrame:
    """Per executor: tasks, busy ms (sum of task durations), span ms of the app,
    busy share of ``span * slots``.  One pass over the tasks; the application span
    is a window over the per-executor rows (one per executor)."""
    per = tasks.groupBy("app", "executor_id").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.sum("duration_ms").alias("busy_ms"),
        F.min("launch_time").alias("first_launch"),
        F.max("finish_time").alias("last_finish"),
    )
    app = Window.partitionBy("app")
    ms = lambda c: F.unix_millis(c.cast("timestamp"))
    span = (ms(F.max("last_finish").over(app)) - ms(F.min("first_launch").over(app))).alias("span_ms")
    return per.select("app", "executor_id", "tasks", "busy_ms", span).select(
        "app", "executor_id", "tasks", "busy_ms", "span_ms",
        F.when(F.col("span_ms") > 0, F.col("busy_ms") / (F.col("span_ms") * F.lit(slots))).alias("busy_share"),
    )


def stage_metrics_long(tasks: DataFrame, exact: bool = True) -> DataFrame:
    """The per-stage metrics as a long table: app, stage_id, stage_attempt, metric,
    value.  With ``exact`` off percentiles are approximate, see :func:`stage_skew`."""
    g = _stage_values(
        tasks.withColumn("run_total", F.col("run_ms")), "run_ms", exact, ["disk_spilled", "memory_spilled", "gc_ms", "run_total"]
    )
    values = {
        "max_over_median": F.when(F.col("median_ms") > 0, F.col("max_ms") / F.col("median_ms")),
        "p95_ms": F.col("p95_ms"),
        "disk_spilled": F.col("disk_spilled"),
        "memory_spilled": F.col("memory_spilled"),
        "gc_share": F.when(F.col("run_total") > 0, F.col("gc_ms") / F.col("run_total")),
    }
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in values.items()])
    return g.select(*STAGE_KEYS, F.inline(pairs))


# Fixed default rules: metric, threshold, severity.
DEFAULT_RULES = [
    ("max_over_median", 2.0, "warn"),
    ("max_over_median", 5.0, "critical"),
    ("gc_share", 0.1, "warn"),
    ("gc_share", 0.3, "critical"),
    ("disk_spilled", 0.0, "warn"),
]


def findings(spark: SparkSession, metrics_long: DataFrame, rules: Sequence[tuple[str, float, str]] | None = None) -> DataFrame:
    """Rules applied to the long metrics: app, stage_id, stage_attempt, metric, value,
    threshold, severity, for every metric value above a rule's threshold.

    The rule table is declared by the caller (a handful of rows) and broadcast; the
    join is on the metric name with the threshold as a condition."""
    rules_df = spark.createDataFrame(list(rules or DEFAULT_RULES), "rule_metric string, threshold double, severity string")
    cond = (F.col("metric") == F.col("rule_metric")) & (F.col("value") > F.col("threshold"))
    return metrics_long.join(F.broadcast(rules_df), cond).select(
        *STAGE_KEYS, "metric", "value", "threshold", "severity"
    )


def concurrency(tasks: DataFrame, bucket_ms: int = 60_000, slots: int | None = None) -> DataFrame:
    """How many tasks an executor ran at a time, per bucket of time: a sweep over task intervals.

    Returns ``app, executor_id, bucket_start, started, finished, open_at_start, peak, busy_ms,
    slots, busy_share`` for every bucket in which a task started, ran or finished.

    A start counts 1 and a finish -1.  Tasks open at a bucket's start are the sum over the
    buckets before, a window over an executor's buckets; the peak is that plus the largest
    running sum within the bucket, a window over one bucket's events (a finish
    before a start at the same millisecond).  Busy time is what the open ones fill of the
    bucket, plus what those that start in it still have of it, less the same for those that finish.
    ``slots``: cores of an executor; by default the executor's own peak, so that the share never passes 1.

    A task of no length takes no slot; tasks without a finish, and those that finish before they
    start, are left out.  Repeated rows are tasks of their own.
    """
    ms = lambda c: F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(c)).cast("timestamp"))
    spans = tasks.select("app", "executor_id", ms("launch_time").alias("s"), ms("finish_time").alias("e")).where("e >= s")
    events = spans.select("app", "executor_id", F.inline(F.array(
        F.struct(F.col("s").alias("at"), F.lit(1).alias("step"), (F.col("e") > F.col("s")).cast("int").alias("held")),
        F.struct(F.col("e").alias("at"), F.lit(-1).alias("step"), (F.col("e") > F.col("s")).cast("int").alias("held")),
    ))).withColumn("bucket", F.floor(F.col("at") / bucket_ms).cast("long"))
    delta = F.col("step") * F.col("held")
    # One row per millisecond at which something happens, so that a busy moment is one event.
    moments = events.groupBy("app", "executor_id", "bucket", "at").agg(
        F.sum(F.when(F.col("step") > 0, 1).otherwise(0)).alias("started"), F.sum(F.when(F.col("step") < 0, 1).otherwise(0)).alias("finished"),
        F.sum(delta).alias("delta"),
    )
    within = Window.partitionBy("app", "executor_id", "bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    left = (F.col("bucket") + 1) * bucket_ms - F.col("at")
    per = moments.withColumn("running", F.sum("delta").over(within)).groupBy("app", "executor_id", "bucket").agg(
        F.sum("started").alias("started"), F.sum("finished").alias("finished"), F.sum("delta").alias("delta"), F.max("running").alias("most"),
        F.sum(F.col("delta") * left).alias("own_ms"),
    )
    order = Window.partitionBy("app", "executor_id").orderBy("bucket")
    carried = per.withColumn("open", F.sum("delta").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("delta"))
    carried = carried.withColumn("next", F.lead("bucket").over(order))
    # Buckets without an event, between two with some, while tasks are open.
    after = F.col("open") + F.col("delta")
    quiet = F.when((after > 0) & (F.col("next") > F.col("bucket") + 1), F.sequence(F.col("bucket") + 1, F.col("next") - 1))
    none = F.lit(0).cast("long")
    filled = carried.select("app", "executor_id", F.explode(quiet).alias("bucket"), none.alias("started"), none.alias("finished"), after.alias("open"), after.alias("peak"), none.alias("own_ms"))
    busy = carried.select("app", "executor_id", "bucket", "started", "finished", "open", F.greatest(F.col("open"), F.col("open") + F.col("most")).alias("peak"), "own_ms")
    every = busy.unionByName(filled).withColumn("busy_ms", F.col("open") * bucket_ms + F.col("own_ms"))
    own = F.greatest(F.max("peak").over(Window.partitionBy("app", "executor_id")), F.lit(1)) if slots is None else F.lit(slots)
    start = F.timestamp_millis(F.col("bucket") * bucket_ms)
    return every.withColumn("slots", own.cast("long")).select(
        "app", "executor_id", F.convert_timezone(F.current_timezone(), F.lit("UTC"), start.cast("timestamp_ntz")).alias("bucket_start"),
        "started", "finished", F.col("open").alias("open_at_start"), "peak", "busy_ms", "slots", (F.col("busy_ms") / (F.col("slots") * bucket_ms)).alias("busy_share"),
    )
