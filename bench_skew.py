"""Skew strategies compared on a generated set (default 50M rows, 80% on one key).

    python bench_skew.py [rows] [cpus]

Aggregation: plain groupBy vs salted_agg.  Join against a dimension too large to
broadcast (one row per key): sort-merge join without AQE, with AQE skew splitting,
salted_join on the hot keys, and hot_key_join.  Each variant is materialised with
the no-op sink; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tablelab.operators import skew as S  # noqa: E402
from tablelab.session import local_session  # noqa: E402
from tablelab.sources.generate import gen_skewed  # noqa: E402


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 2)


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 50_000_000
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = local_session(
        cpus,
        app="tablelab-skew",
        **{
            "spark.sql.shuffle.partitions": "64",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.driver.memory": "8g",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16MB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
        },
    )
    facts = gen_skewed(spark, rows)  # 80% on customer_id 1, the rest on 50 keys
    dim_rows = max(1_000_000, rows // 10)
    dim = spark.range(1, dim_rows + 1).select(
        F.col("id").alias("customer_id"), (F.col("id") % 97).alias("segment"), F.sha1(F.col("id").cast("string")).alias("pad")
    )
    aggs = [S.Agg("n", "count"), S.Agg("total", "sum", F.col("amount").cast("decimal(18,2)"))]
    out: dict[str, float] = {}
    # Warm the JVM once (code generation, JIT) so the first variant is not penalised.
    facts.groupBy((F.col("transaction_id") % 7).alias("k")).count().write.format("noop").mode("overwrite").save()

    out["agg_plain"] = timed(
        lambda: facts.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(18,2)")))
    )
    out["agg_salted"] = timed(lambda: S.salted_agg(facts, "customer_id", aggs, ["transaction_id"], n=32))

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    out["join_smj_no_aqe"] = timed(lambda: facts.join(dim, "customer_id"))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    out["join_aqe_no_skew_split"] = timed(lambda: facts.join(dim, "customer_id"))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    out["join_aqe_skew_split"] = timed(lambda: facts.join(dim, "customer_id"))
    hot = S.hot_keys(facts, "customer_id", 0.05)
    out["join_salted_hot"] = timed(lambda: S.salted_join(facts, dim, "customer_id", ["transaction_id"], n=32, hot_keys=hot))
    out["join_hot_key"] = timed(lambda: S.hot_key_join(facts, dim, "customer_id", ["transaction_id"], threshold=0.05))

    print(json.dumps({"metric": "skew_strategies_sec", "rows": rows, "cpus": int(cpus), "results": out}))
    spark.stop()


if __name__ == "__main__":
    main()
