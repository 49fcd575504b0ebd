"""Registered plans: event-log analytics (build-list step 8).

The log is derived from ``events`` (one task per event, see
``derived.task_end_lines``), written as a rolling event-log folder in shared
scratch and read back through the same reader a real log uses.
"""

from __future__ import annotations

from tablelab.operators import eventlog as EL
from tablelab.plans.registry import register
from tablelab.session import scratch_dir, session_fixture, table
from tablelab.sources import derived as D
from tablelab.sources import eventlog as ES

APP = "app-events"
#: Lines of a part of the log, about 40 MB before compression: a compressed part is read by one task.
PART_LINES = 100_000


def _write_log(spark, sf_dir) -> str:
    root = scratch_dir(spark, "eventlog")
    lines = D.task_end_lines(table(spark, sf_dir, "events")).write.option("maxRecordsPerFile", PART_LINES)
    # Field names fill most of a line, so that plain text is about 40 times the events' Parquet.
    lines.text(f"{root}/eventlog_v2_{APP}", compression="gzip")
    return root


def tasks(spark, sf_dir):
    # The log is written once per application; every report reads it back.
    root = session_fixture(spark, f"eventlog:{sf_dir}", lambda: _write_log(spark, sf_dir))
    return ES.task_metrics(ES.read_log_lines(spark, f"{root}/eventlog_v2_*"))


# Oracle: the same rules in SQL.
_TASKS = f"""
(select '{APP}' as app, user_id % 10 as stage_id, cast(0 as bigint) as stage_attempt, event_id as task_id,
        cast(0 as bigint) as attempt,
        cast(user_id % 4 as varchar) as executor_id, concat('host-', user_id % 4) as host,
        make_timestamp((epoch_us(ts) // 1000) * 1000) as launch_time,
        make_timestamp(((epoch_us(ts) // 1000) + cast(round(value) as bigint) + 5) * 1000) as finish_time,
        cast(round(value) as bigint) + 5 as duration_ms,
        cast(round(value) as bigint) as run_ms, cast(round(value) as bigint) * 1000000 as cpu_ns,
        event_id % 7 as gc_ms,
        case when event_type = 'purchase' then event_id * 1024 else 0 end as memory_spilled,
        case when event_type = 'purchase' then event_id * 512 else 0 end as disk_spilled,
        user_id * 1000 as peak_memory, event_id * 8 as input_bytes, user_id % 5 as fetch_wait_ms,
        event_id * 10 as remote_bytes_read, event_id * 3 as local_bytes_read, event_id % 100 as records_read,
        user_id * 100 as shuffle_bytes_written,
        case when event_type <> 'error' then 'Success' when event_id % 2 = 0 then 'FetchFailed'
             else 'ExceptionFailure' end as reason,
        case when event_type = 'error' and event_id % 2 = 1 then 'java.lang.RuntimeException' end as error_class,
        event_type = 'error' as failed
 from events)
"""


@register("eventlog_tasks", f"select * from {_TASKS} t")
def eventlog_tasks(spark, sf_dir):
    return tasks(spark, sf_dir)


@register(
    "eventlog_stage_skew",
    f"""
with g as (select app, stage_id, stage_attempt, count(*) as tasks,
                  cast(quantile_disc(run_ms, 0.5) as double) as median_ms, cast(quantile_disc(run_ms, 0.95) as double) as p95_ms,
                  max(run_ms) as max_ms
           from {_TASKS} t group by all)
select *, case when median_ms > 0 then max_ms / median_ms end as max_over_median,
       coalesce(case when median_ms > 0 then max_ms / median_ms end > 2.0, max_ms > 0) as skewed
from g
""",
)
def eventlog_stage_skew(spark, sf_dir):
    return EL.stage_skew(tasks(spark, sf_dir))


@register(
    "eventlog_memory",
    f"""
select app, stage_id, stage_attempt, cast(sum(memory_spilled) as bigint) as memory_spilled,
       cast(sum(disk_spilled) as bigint) as disk_spilled, cast(sum(gc_ms) as bigint) as gc_ms,
       cast(sum(run_ms) as bigint) as run_ms,
       case when sum(run_ms) > 0 then sum(gc_ms) / sum(run_ms) end as gc_share
from {_TASKS} t group by all
""",
)
def eventlog_memory(spark, sf_dir):
    return EL.stage_memory(tasks(spark, sf_dir))


@register(
    "eventlog_failures",
    f"select app, reason, executor_id, count(*) as n from {_TASKS} t where failed group by all",
)
def eventlog_failures(spark, sf_dir):
    return EL.failures(tasks(spark, sf_dir))


@register(
    "eventlog_executors",
    f"""
with t as {_TASKS},
s as (select app, epoch_ms(max(finish_time)) - epoch_ms(min(launch_time)) as span_ms from t group by app)
select t.app, executor_id, count(*) as tasks, cast(sum(duration_ms) as bigint) as busy_ms, max(s.span_ms) as span_ms,
       sum(duration_ms) / (max(s.span_ms) * 4) as busy_share
from t join s on t.app = s.app group by t.app, executor_id
""",
)
def eventlog_executors(spark, sf_dir):
    return EL.executor_use(tasks(spark, sf_dir), slots=4)


@register(
    "eventlog_findings",
    f"""
with t as {_TASKS},
g as (select app, stage_id, stage_attempt,
             cast(quantile_disc(run_ms, 0.5) as double) as med, max(run_ms) as mx,
             sum(disk_spilled) as disk, sum(gc_ms) as gc, sum(run_ms) as run
      from t group by all),
m as (
  select app, stage_id, stage_attempt, 'max_over_median' as metric,
         case when med > 0 then mx / med end as value from g
  union all select app, stage_id, stage_attempt, 'disk_spilled', cast(disk as double) from g
  union all select app, stage_id, stage_attempt, 'gc_share', case when run > 0 then gc / run end from g),
r as (select * from (values ('max_over_median', 2.0, 'warn'), ('max_over_median', 5.0, 'critical'),
                            ('gc_share', 0.1, 'warn'), ('gc_share', 0.3, 'critical'), ('disk_spilled', 0.0, 'warn'))
      v(rule_metric, threshold, severity))
select app, stage_id, stage_attempt, metric, value, cast(threshold as double) as threshold, severity
from m join r on m.metric = r.rule_metric and m.value > r.threshold
""",
)
def eventlog_findings(spark, sf_dir):
    return EL.findings(spark, EL.stage_metrics_long(tasks(spark, sf_dir)))


@register(
    "eventlog_concurrency",
    f"""
with t as (select app, executor_id, epoch_ms(launch_time) as s, epoch_ms(finish_time) as e from {_TASKS} t),
m as (select app, executor_id, s, e, unnest(range(s // 60000, e // 60000 + 1)) as b from t),
busy as (
  select app, executor_id, b, count_if(s // 60000 = b) as started, count_if(e // 60000 = b) as finished,
         count_if(s // 60000 < b) as open_at_start,
         cast(sum(least(e, (b + 1) * 60000) - greatest(s, b * 60000)) as bigint) as busy_ms
  from m group by all),
steps as (select app, executor_id, s as moment, 1 as d from t union all select app, executor_id, e, -1 from t),
sums as (select app, executor_id, moment, sum(sum(d)) over (partition by app, executor_id order by moment) as running from steps group by app, executor_id, moment),
peaks as (select app, executor_id, moment // 60000 as b, max(running) as most from sums group by all),
every as (
  select busy.*, greatest(open_at_start, coalesce(most, 0)) as peak from busy left join peaks using (app, executor_id, b))
select app, executor_id, make_timestamp(b * 60000000) as bucket_start, started, finished, open_at_start, cast(peak as bigint) as peak, busy_ms,
       cast(max(peak) over (partition by app, executor_id) as bigint) as slots,
       busy_ms / (max(peak) over (partition by app, executor_id) * 60000) as busy_share
from every
""",
)
def eventlog_concurrency(spark, sf_dir):
    return EL.concurrency(tasks(spark, sf_dir))
