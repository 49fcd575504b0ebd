"""Registered plans: Python functions on Arrow batches (build-list step 8)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablelab.operators import udf as U
from tablelab.plans.registry import register
from tablelab.session import table


def _net_cents(pdf: pd.DataFrame, res) -> pd.DataFrame:
    # Exact integer arithmetic in cents, rounded half up.
    scale = res["scale"]
    ext = np.rint(pdf["l_extendedprice"].to_numpy() * scale).astype(np.int64)
    disc = np.rint(pdf["l_discount"].to_numpy() * scale).astype(np.int64)
    num = ext * (scale - disc)
    return pd.DataFrame(
        {"l_orderkey": pdf["l_orderkey"], "l_linenumber": pdf["l_linenumber"], "net_cents": (num + scale // 2) // scale}
    )


def _setup():
    # Built inside each task: stands for a resource that cannot be pickled.
    return {"scale": 100}


@register(
    "udf_vectorized",
    """
select l_orderkey, l_linenumber,
       cast(round(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2))) * 100) as bigint)
         as net_cents
from lineitem
""",
)
def udf_vectorized(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return U.map_vectorized(li, _net_cents, "l_orderkey long, l_linenumber int, net_cents long", setup=_setup)


def _label(row: dict, _res) -> dict:
    if row["event_type"] == "error":
        raise ValueError("error events cannot be labelled")
    return {"event_id": row["event_id"], "label": row["event_type"].upper()}


@register(
    "udf_error_rows",
    """
select event_id,
       case when event_type = 'error' then null else upper(event_type) end as label,
       case when event_type = 'error' then 'error' else 'ok' end as status,
       case when event_type = 'error' then 'ValueError' end as error_class
from events
""",
)
def udf_error_rows(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    out = U.map_catching(ev, _label, "event_id long, label string")
    return out.select(
        F.coalesce(F.col("event_id"), F.get_json_object("__input", "$.event_id").cast("long")).alias("event_id"),
        "label",
        F.when(F.col("__ok"), F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        F.col("__error_class").alias("error_class"),
    )
