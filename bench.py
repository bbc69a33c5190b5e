"""Benchmark the headline assessment queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned afresh and run to completion into Spark's ``noop``
sink (every row is computed, nothing is collected): one warm-up run, then
the median of ``BENCH_RUNS`` timed runs.  Prints one JSON line.
``BENCH_EVENT_LOG=<folder>`` also writes Spark's event log there (see
``tools/stage_times.py``).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from estate.plans.queries import QUERIES  # noqa: E402
from estate.session import get_session, shared_dir  # noqa: E402

# Every registered query; the staging ones include their writes.
HEADLINE = list(QUERIES)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    event_dir = os.environ.get("BENCH_EVENT_LOG")      # optional: a scratch folder
    spark = get_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="estate-bench",
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir}
                        if event_dir else None)
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    timings = {}
    for name in names:
        run_once(spark, name, sf_dir)                       # warm-up
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir)
                                                for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
