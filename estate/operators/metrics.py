"""Metric series: flatten dumped responses, profile and roll up (S40-S43,
A6, P12).

A dumped metric response is one row ``resource_id, name, timeseries``
where ``timeseries`` is ``array<struct<data: array<point>>>`` and a point is
``timestamp, average, count, maximum, minimum, total``.  A response covers
one resource and metric over a bounded span at a fixed grain, so its arrays
are bounded by span / grain (8,640 points for 90 days at 15 minutes).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate.functions.timefns import utc_wall_clock

# --- fixed values (must equal the reference's, stated here together) --------
DEDICATED_METRICS = ("DWULimit", "DWUUsed", "DWUUsedPercent", "MemoryUsedPercent",
                     "CPUPercent", "Connections", "ActiveQueries")
SPARK_POOL_METRICS = ("BigDataPoolApplicationsEnded", "BigDataPoolAllocatedCores",
                      "BigDataPoolAllocatedMemory", "BigDataPoolApplicationsActive")
WORKSPACE_METRICS = ("IntegrationActivityRunsEnded", "IntegrationPipelineRunsEnded",
                     "IntegrationTriggerRunsEnded", "BuiltinSqlPoolDataProcessedBytes",
                     "BuiltinSqlPoolLoginAttempts", "BuiltinSqlPoolRequestsEnded")
PROFILES = {
    # kind: (metric names, span in days, grain)
    "dedicated": (DEDICATED_METRICS, 90, "15 minutes"),
    "spark": (SPARK_POOL_METRICS, 90, "15 minutes"),
    "workspace": (WORKSPACE_METRICS, 90, "1 hour"),
}
POINT_FIELDS = ("timestamp", "average", "count", "maximum", "minimum", "total")
# ---------------------------------------------------------------------------


def flatten(responses: DataFrame, carry: Sequence[str] = ("resource_id",)) -> DataFrame:
    """One row per point - ``name, timestamp, average, count, maximum,
    minimum, total`` (plus ``carry`` columns) - through two ``explode``s.
    Series and points are never regrouped, so nothing crosses a shuffle.  A
    zoned point time becomes UTC wall clock (timestamp without time zone)."""
    carry = [c for c in carry if c in responses.columns]
    series = responses.select(*carry, "name", F.explode("timeseries").alias("_ts"))
    points = series.select(*carry, "name", F.explode("_ts.data").alias("_p"))
    return utc_wall_clock(
        points.select(*carry, "name", *[F.col(f"_p.{f}").alias(f) for f in POINT_FIELDS]))


def rollup(points: DataFrame, grain: str, ts_col: str = "ts", value_col: str = "value",
           keys: Sequence[str] = ("resource_id", "name")) -> DataFrame:
    """Average, count, minimum, maximum and total of raw values per
    ``grain`` bucket and key (the aggregation the metrics service returns).
    Partial aggregation runs before the shuffle, so hot keys cost little."""
    bucket = F.window(F.col(ts_col), grain).start.cast("timestamp_ntz")
    v = F.col(value_col)
    return (points.groupBy(*keys, bucket.alias("timestamp"))
            .agg(F.avg(v).alias("average"), F.count(v).cast("double").alias("count"),
                 F.max(v).alias("maximum"), F.min(v).alias("minimum"),
                 F.sum(v).alias("total")))


def coarsen(points: DataFrame, grain: str, keys: Sequence[str] = ("resource_id", "name")) -> DataFrame:
    """Roll already-aggregated points up to a coarser grain (e.g. 15 minutes
    to 1 hour): counts and totals add, extremes combine, the average is
    total / count.  Exact, because every field is mergeable."""
    bucket = F.window(F.col("timestamp"), grain).start.cast("timestamp_ntz")
    agg = (points.groupBy(*keys, bucket.alias("_bucket"))
           .agg(F.sum("count").alias("count"), F.max("maximum").alias("maximum"),
                F.min("minimum").alias("minimum"), F.sum("total").alias("total")))
    return agg.select(*keys, F.col("_bucket").alias("timestamp"),
                      (F.col("total") / F.col("count")).alias("average"),
                      "count", "maximum", "minimum", "total")


def profile(points: DataFrame, kind: str, end=None, ts_col: str = "ts",
            value_col: str = "value", keys: Sequence[str] = ("resource_id", "name")) -> DataFrame:
    """S41-S43 + P12: the named metrics of a resource kind over the last
    span of days before ``end``, rolled up at the profile grain.

    ``end`` defaults to the latest timestamp in ``points`` - one scalar
    aggregate - and enters the plan as a literal, so the span predicate is
    pushed into the scan."""
    names, days, grain = PROFILES[kind]
    sel = points.filter(F.col("name").isin(*names))
    if end is None:
        end = sel.agg(F.max(ts_col).alias("end")).first()["end"]
        if end is None:
            return rollup(sel, grain, ts_col, value_col, keys)
    start = end - _dt.timedelta(days=days)
    sel = sel.filter(F.col(ts_col) >= F.lit(start.isoformat(sep=" ")).cast(
        sel.schema[ts_col].dataType))
    return rollup(sel, grain, ts_col, value_col, keys)
