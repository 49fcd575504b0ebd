"""Registered plans: quarantine, drift, reconcile (build-list step 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.operators import infer as N
from tablelab.operators import quality as Q
from tablelab.plans.registry import register
from tablelab.session import scratch_dir, table
from tablelab.sources import csv_records as C
from tablelab.sources import derived as D

_CSV_REASON = """case event_id % 12 when 3 then 'bad_type' when 5 then 'too_few_fields'
                 when 8 then 'too_many_fields' when 11 then 'open_quote' end"""
_JSON_REASON = "case event_id % 12 when 2 then 'not_object' when 4 then 'not_json' when 7 then 'bad_type' end"
_BEYOND = "concat(repeat('9', 20), user_id)"
_JSON_GOOD = """concat('{"event_id":', event_id, ',"user_id":', user_id, ',"event_type":"', event_type, '"}')"""


@register(
    "csv_quarantine",
    f"""
with t as (select *, {_CSV_REASON} as reason from events)
select case when reason is null then event_id end as event_id,
       case when reason is null and event_id % 12 <> 9 then user_id end as user_id,
       case when reason is null then concat(event_type, case when event_id % 12 = 6 then ', again' else '' end) end as event_type,
       reason,
       case event_id % 12
         when 3 then concat(event_id, ',', {_BEYOND}, ',', event_type)
         when 5 then concat(event_id, ';', user_id, ';', event_type)
         when 8 then concat(event_id, ',', user_id, ',', event_type[:2], ',', event_type[3:])
         when 11 then concat('"', event_id, ',', user_id, ',', event_type) end as value
from t
""",
)
def csv_quarantine(spark, sf_dir):
    # One parse per line: good rows carry fields, bad rows carry reason and line.
    tagged = Q.tag_csv(D.csv_lines(table(spark, sf_dir, "events")), D.CSV_SCHEMA, header=D.CSV_HEADER)
    bad = F.col("reason").isNotNull()
    return tagged.select("event_id", "user_id", "event_type", "reason", F.when(bad, F.col("value")).alias("value"))


@register(
    "json_quarantine",
    f"""
with t as (select *, {_JSON_REASON} as reason from events)
select case when reason is null then event_id end as event_id,
       case when reason is null and event_id % 12 <> 10 then user_id end as user_id,
       case when reason is null then event_type end as event_type,
       case when reason is null then case when event_id % 12 = 9 then 'region' else '' end end as extra_keys,
       reason,
       case event_id % 12
         when 2 then concat('[', event_id, ',', user_id, ',"', event_type, '"]')
         when 4 then {_JSON_GOOD}[:-4]
         when 7 then concat('{{"event_id":', event_id, ',"user_id":', {_BEYOND}, ',"event_type":"', event_type, '"}}')
       end as value
from t
""",
)
def json_quarantine(spark, sf_dir):
    tagged = Q.tag_json(D.json_lines(table(spark, sf_dir, "events")), D.JSON_SCHEMA)
    bad = F.col("reason").isNotNull()
    keys = F.array_join(F.array_sort(F.map_keys(Q.EXTRA)), ",")
    return tagged.select(
        "event_id", "user_id", "event_type", keys.alias("extra_keys"), "reason", F.when(bad, F.col("value")).alias("value")
    )


@register(
    "quarantine_summary",
    f"""
with t as (select count(*) as lines from events),
b as (
  select 'events.csv' as source, {_CSV_REASON} as reason from events where event_id % 12 in (3, 5, 8, 11)
  union all
  select 'events.json' as source, {_JSON_REASON} as reason from events where event_id % 12 in (2, 4, 7)
)
select source, reason, count(*) as n, count(*) / max(t.lines) as share
from b, t group by source, reason
""",
)
def quarantine_summary(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cols = ["source", "reason"]
    csv = Q.tag_csv(D.csv_lines(events), D.CSV_SCHEMA, header=D.CSV_HEADER).select(*cols)
    js = Q.tag_json(D.json_lines(events), D.JSON_SCHEMA, keep_extra=False).select(*cols)
    return Q.summarize_tagged(csv.unionByName(js))


@register(
    "csv_multiline",
    """
with t as (select *, event_id % 8 as turn from events)
select case when turn <> 5 then event_id end as event_id, case when turn <> 5 then user_id end as user_id,
       case turn when 1 then concat(event_type, chr(10), 'seen,by,all', chr(10), 'end ', event_id)
                 when 3 then concat('said "', event_type, '"', chr(10), 'then left')
                 when 5 then null when 6 then concat(event_type, ', again') else event_type end as note,
       case when turn = 5 then 'open_quote' end as reason,
       case when turn = 5 then concat(event_id, ',', user_id, ',"', event_type) end as value
from t
""",
)
def csv_multiline(spark, sf_dir):
    # Written as text, so that a record's line breaks are the file's.
    root = scratch_dir(spark, "notes")
    D.note_records(table(spark, sf_dir, "events")).write.text(root)
    tagged = Q.tag_csv(C.read_csv_records(spark, root), "event_id long, user_id long, note string")
    bad = F.col("reason").isNotNull()
    return tagged.select("event_id", "user_id", "note", "reason", F.when(bad, F.col("value")).alias("value"))


# --- drift ---------------------------------------------------------------------

DRIFT_ALIASES = {"orderkey": "o_orderkey"}
RECONCILE_ALIASES = {"orderkey": "o_orderkey", "cust": "o_custkey"}


def drifted_orders(orders: DataFrame) -> DataFrame:
    """``orders`` as a drifted feed: one column renamed with a declared alias, one
    renamed without, a type change (prices as text, one in a thousand unreadable),
    two columns swapped and one extra column."""
    price = F.when(F.pmod("o_orderkey", F.lit(1000)) == 7, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    return orders.select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("cust"),
        "o_orderstatus",
        price.alias("o_totalprice"),
        "o_orderpriority",
        "o_orderdate",
        F.pmod(F.col("o_orderkey"), F.lit(7)).alias("o_shippriority"),
    )


@register(
    "schema_drift",
    """
select t.*, case when t.column_name = 'o_totalprice' then f.fails end as cast_failures
from (values
  ('o_orderkey', 'orderkey', 'renamed', 'bigint', 'bigint', 0, 0),
  ('o_custkey', null, 'missing', 'bigint', null, 1, null),
  ('o_orderstatus', 'o_orderstatus', 'same', 'string', 'string', 2, 2),
  ('o_totalprice', 'o_totalprice', 'type_changed', 'double', 'string', 3, 3),
  ('o_orderdate', 'o_orderdate', 'moved', 'timestamp_ntz', 'timestamp_ntz', 4, 5),
  ('o_orderpriority', 'o_orderpriority', 'moved', 'string', 'string', 5, 4),
  (null, 'cust', 'extra', null, 'bigint', null, 1),
  (null, 'o_shippriority', 'extra', null, 'bigint', null, 6)
) t(column_name, observed_name, status, baseline_type, observed_type, baseline_pos, observed_pos),
(select count_if(p is not null and try_cast(p as double) is null) as fails
 from (select case when o_orderkey % 1000 = 7 then 'n/a' else cast(o_totalprice as varchar) end as p
       from orders)) f
""",
)
def schema_drift(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return Q.schema_drift(spark, drifted_orders(orders), orders, DRIFT_ALIASES)


@register(
    "schema_reconcile",
    """
select o_orderkey, o_custkey, o_orderstatus,
       case when o_orderkey % 1000 = 7 then null else o_totalprice end as o_totalprice,
       o_orderdate, o_orderpriority,
       concat('{"o_shippriority":"', o_orderkey % 7, '"}') as extra_json,
       case when o_orderkey % 1000 = 7 then 'n/a' end as unread_price
from orders
""",
)
def schema_reconcile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    fixed = Q.reconcile(drifted_orders(orders), orders, RECONCILE_ALIASES)
    fixed = fixed.withColumn("extra_json", F.to_json(Q.EXTRA)).withColumn("unread_price", F.col(Q.FAILED)["o_totalprice"])
    return fixed.drop(Q.EXTRA, Q.FAILED)


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "urgent"]


def _order_lines(orders: DataFrame) -> DataFrame:
    """``orders`` as CSV text without types: one price in a thousand unreadable, some customers missing."""
    price = F.when(F.pmod("o_orderkey", F.lit(1000)) == 7, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    customer = F.when(F.pmod("o_orderkey", F.lit(9)) != 0, F.col("o_custkey")).cast("string")
    fields = [
        F.col("o_orderkey").cast("string"), F.coalesce(customer, F.lit("")), price, F.col("o_orderdate").cast("date").cast("string"),
        F.concat(F.lit('"'), "o_orderpriority", F.lit('"')), (F.col("o_orderpriority") == "1-URGENT").cast("string"),
    ]
    return orders.select(F.concat_ws(",", *fields).alias("value"))


@register(
    "infer_csv_types",
    """
with o as (select *, case when o_orderkey % 1000 = 7 then 1 else 0 end as odd from orders)
select 'o_orderkey' as column_name, 'bigint' as type, count(*) as n, 0 as nulls, null::varchar as mostly, null::bigint as misfits, null::varchar as example from o
union all select 'o_custkey', 'bigint', count_if(o_custkey is not null and o_orderkey % 9 <> 0), count_if(o_custkey is null or o_orderkey % 9 = 0), null, null, null from o
union all select 'o_totalprice', case when sum(odd) > 0 then 'string' else 'double' end, count(*), 0,
  case when sum(odd) > 0 then 'double' end, case when sum(odd) > 0 then sum(odd) end, case when sum(odd) > 0 then 'n/a' end from o
union all select 'o_orderdate', 'date', count(*), 0, null, null, null from o
union all select 'o_orderpriority', 'string', count(*), 0, null, null, null from o
union all select 'urgent', 'boolean', count(*), 0, null, null, null from o
""",
)
def infer_csv_types(spark, sf_dir):
    cells = N.csv_cells(_order_lines(table(spark, sf_dir, "orders")), ",".join(_ORDER_COLS))
    return N.infer_types(cells)


def _event_objects(events: DataFrame) -> DataFrame:
    """``events`` as JSON objects: numbers that are text now and then, a nested object, an optional field."""
    number = F.col("value").cast("decimal(18,2)").cast("string")
    value = F.when(F.pmod("event_id", F.lit(100)) == 3, F.concat(F.lit('"'), number, F.lit(' eur"'))).otherwise(number)
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    extra = F.when(F.pmod("event_id", F.lit(4)) == 0, F.concat(F.lit(',"seen":'), (F.col("user_id") % 2 == 0).cast("string"))).otherwise(F.lit(""))
    parts = [
        F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"value":'), value, F.lit(',"at":"'), at, F.lit('","props":'), F.col("props"),
        extra, F.lit("}"),
    ]
    return events.select(F.concat(*parts).alias("value"))


@register(
    "infer_json_types",
    """
select 'id' as column_name, 'bigint' as type, count(*) as n, 0 as nulls, null::varchar as mostly, null::bigint as misfits, null::varchar as example from events
union all select 'value', 'string', count(*), 0, 'double', count_if(event_id % 100 = 3),
  min(case when event_id % 100 = 3 then concat('"', cast(cast(value as decimal(18,2)) as varchar), ' eur"') end) from events
union all select 'at', 'timestamp_ntz', count(*), 0, null, null, null from events
union all select 'props', 'object', count(*), 0, null, null, null from events
union all select 'props.k', 'bigint', count(*), 0, null, null, null from events
union all select 'seen', 'boolean', count_if(event_id % 4 = 0), 0, null, null, null from events
""",
)
def infer_json_types(spark, sf_dir):
    return N.infer_types(N.json_cells(_event_objects(table(spark, sf_dir, "events")), depth=2))


# --- expectations ----------------------------------------------------------------

from tablelab.operators import expect as X  # noqa: E402


@register(
    "expectations",
    """
select 0 as ordinal, 'o_custkey not null' as label, count_if(o_custkey is null) = 0 as passed,
       cast(count_if(o_custkey is null) as bigint) as violations, concat('violations=', count_if(o_custkey is null)) as detail from orders
union all
select 1, 'o_totalprice in [0, 500000]', count_if(o_totalprice < 0 or o_totalprice > 500000) = 0,
       cast(count_if(o_totalprice < 0 or o_totalprice > 500000) as bigint),
       concat('violations=', count_if(o_totalprice < 0 or o_totalprice > 500000)) from orders
union all
select 2, 'o_totalprice <= 400000', count_if(o_totalprice > 400000) = 0,
       cast(count_if(o_totalprice > 400000) as bigint),
       concat('violations=', count_if(o_totalprice > 400000)) from orders
union all
select 3, 'row count >= 1000', count(*) >= 1000, cast(count(*) < 1000 as bigint), concat('rows=', count(*)) from orders
union all
select 4, 'o_orderkey unique', count(*) = 0, count(*), concat('duplicate keys=', count(*))
from (select o_orderkey from orders where o_orderkey is not null group by o_orderkey having count(*) > 1)
union all
select 5, 'has o_orderpriority', true, 0, 'ok'
union all
select 6, 'lacks region', true, 0, 'ok'
""",
)
def expectations(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return X.expect(
        orders,
        [
            X.not_null("o_custkey"),
            X.in_range("o_totalprice", 0, 500000),
            X.satisfies("o_totalprice <= 400000", "o_totalprice <= 400000"),
            X.row_count(lo=1000, label="row count >= 1000"),
            X.unique("o_orderkey"),
            X.has_columns(["o_orderpriority"]),
            X.lacks_columns(["region"]),
        ],
    )
