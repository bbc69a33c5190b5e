"""Summarise the physical plan of every registered query.

    python tools/plan_summary.py [sf_dir] > docs/PLANS.md

For each query: scans with their read schema and pushed filters, shuffles,
join strategies, aggregates (partial / final), and whether any Python runs.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from estate.plans.queries import QUERIES  # noqa: E402
from estate.session import get_session, shared_dir  # noqa: E402


def summarise(plan: str) -> dict:
    scans = []
    for line in plan.splitlines():
        if "FileScan" not in line:
            continue
        loc = re.search(r"Location: \w+(?:\(\d+ paths\))?\[([^\]]*)\]", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        parts = re.search(r"PartitionFilters: \[([^\]]*)\]", line)
        schema = re.search(r"ReadSchema: (\S+)", line)
        path = loc.group(1).split(",")[0] if loc else "?"
        scans.append((os.path.basename(path.rstrip("/")) if "estate-runs" not in path
                      else "staged:" + os.path.basename(path.rstrip("/")),
                      (pushed.group(1) if pushed else ""),
                      (parts.group(1) if parts else ""),
                      (schema.group(1) if schema else "")))
    return {
        "scans": scans,
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                                    r"RoundRobinPartitioning)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                       r"BroadcastNestedLoopJoin|CartesianProduct) ?(\w*)", plan))),
        "partial_agg": "partial_" in plan,
        "python": any(m in plan for m in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF",
                                          "InPandas")),
        "generate": "Generate" in plan,
        "topk": "TakeOrderedAndProject" in plan,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_summary.py` at `{sf_dir}` (AQE on; the plans are the "
          "initial ones, before runtime re-planning). Queries that stage data run their "
          "writes while being built; their final plan reads the staged Parquet.\n")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"## `{name}`\n")
        print(f"- shuffles: {s['exchanges']}, broadcasts: {s['broadcasts']}, "
              f"joins: {', '.join(' '.join(j).strip() for j in s['joins']) or 'none'}, "
              f"partial aggregation: {'yes' if s['partial_agg'] else 'no'}, "
              f"top-k: {'yes' if s['topk'] else 'no'}, explode: {'yes' if s['generate'] else 'no'}, "
              f"Python in plan: {'yes' if s['python'] else 'no'}")
        for table, pushed, parts, schema in s["scans"]:
            print(f"- scan `{table}`: ReadSchema `{schema}`"
                  + (f"; PushedFilters `{pushed}`" if pushed else "")
                  + (f"; PartitionFilters `{parts}`" if parts else ""))
        print()
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
