"""Run every registered key and summarise its executed (final adaptive) plan.

    python tools/plan_digest.py [sf_dir] > PLANS.md

Per key: file scans, shuffles (hash / range / single partition), broadcast and
sort-merge joins, generated-code stages, Python stages, and the filters pushed to
the Parquet scan.  Counts are for the top-level plan that actually ran.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablelab.plans import registry  # noqa: E402
from tablelab.session import local_session  # noqa: E402


def digest(text: str) -> dict:
    final = text.split("\n+- == Initial Plan ==")[0]
    pushed = sorted(set(p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", final) if p))
    return {
        "scans": len(re.findall(r"(FileScan|BatchScan|Scan ExistingRDD|Scan OneRowRelation|Range \()", final)),
        "hash": len(re.findall(r"Exchange hashpartitioning", final)),
        "range": len(re.findall(r"Exchange rangepartitioning", final)),
        "single": len(re.findall(r"Exchange SinglePartition", final)),
        "reused": len(re.findall(r"Reused(Exchange|Subquery)", final)),
        "bhj": len(re.findall(r"BroadcastHashJoin", final)),
        "smj": len(re.findall(r"SortMergeJoin", final)),
        "codegen": len(set(re.findall(r"\*\((\d+)\)", final))),
        "python": len(re.findall(r"(MapIn(?:Pandas|Arrow)|ArrowEvalPython|FlatMap\w+In(?:Pandas|Arrow)|BatchEvalPython)", final)),
        "pushed": "; ".join(pushed)[:160],
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, app="tablelab-plans")
    print(f"# Executed plans at {os.path.basename(sf_dir)} (final adaptive plans)\n")
    print("Generated by `tools/plan_digest.py`.  Streaming keys show the plan of the batch read of the")
    print("sink; their stream plans are covered by the tests.\n")
    print("| key | scans | hash shuffles | range | single-partition | reused | broadcast joins | sort-merge joins | codegen stages | Python stages | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for key, e in sorted(registry.entries().items()):
        df = e.plan(spark, sf_dir)
        df.collect()  # run this DataFrame so its own plan is the final adaptive one
        d = digest(df._jdf.queryExecution().executedPlan().toString())
        print(
            f"| `{key}` | {d['scans']} | {d['hash']} | {d['range']} | {d['single']} | {d['reused']} | {d['bhj']} | "
            f"{d['smj']} | {d['codegen']} | {d['python']} | {d['pushed'] or '—'} |"
        )
    spark.stop()


if __name__ == "__main__":
    main()
