"""Physical-plan properties of the registered queries: no Python in any
plan, partial aggregation before shuffles, pruned scans, and hot keys that
stay spread over tasks."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from estate.operators import analysis
from estate.plans.queries import QUERIES, staged_requests

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plan(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "InPandas", "InArrow"):
        assert marker not in plan, (name, marker)


@pytest.mark.parametrize("name", ["request_window", "command_mix", "storage_by_node",
                                  "metric_rollup_15m", "dataset_profile"])
def test_partial_aggregation_before_exchange(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "partial_" in plan and "Exchange" in plan, name


def test_request_window_reads_only_needed_columns(spark):
    plan = _plan(entry.queries()["request_window"](spark, SF_SMALL))
    schema = plan.split("ReadSchema: ")[1].split("\n")[0] if "ReadSchema: " in plan else plan
    assert "props" not in schema and "event_type" not in schema and "value" not in schema


def test_hot_pool_is_aggregated_in_parallel(spark):
    """One pool holding well over a third of the rows: the window report
    still aggregates partially in every input task and returns whole counts."""
    reqs = staged_requests(spark, SF_SMALL)
    hot = reqs.withColumn("pool_name", F.when(F.col("request_id") % 3 != 0, F.lit("hot"))
                          .otherwise(F.col("pool_name"))).repartition(8)
    out = analysis.request_window(hot)
    total = sum(r.num_requests for r in out.collect())
    assert total == reqs.count()
    assert "partial_count" in _plan(out)
