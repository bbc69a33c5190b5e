"""Assessment reports over staged data.

Every report is a grouped aggregate with map-side partial aggregation, so a
group holding a third of all rows costs one partial row per task before the
shuffle.  No report collects a group into a list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate.functions.timefns import whole_units

PAGE_KB = 8  # fixed value: size of one storage page in KB


def request_window_parts(requests: DataFrame, by: tuple[str, ...] = ("pool_name",)) -> DataFrame:
    """Partial A2: earliest and latest start time and row count per extract
    and key.  These are mergeable, so partial rows of separate batches can be
    combined later by :func:`merge_request_windows`."""
    return (requests.groupBy("extract_ts", *by)
            .agg(F.min("start_time").alias("min_request_start_time"),
                 F.max("start_time").alias("max_start_time"),
                 F.count(F.lit(1)).alias("num_requests")))


def merge_window_parts(parts: DataFrame, by: tuple[str, ...] = ("pool_name",)) -> DataFrame:
    """Partial rows of many batches as one partial row per extract and key."""
    return (parts.groupBy("extract_ts", *by)
            .agg(F.min("min_request_start_time").alias("min_request_start_time"),
                 F.max("max_start_time").alias("max_start_time"),
                 F.sum("num_requests").alias("num_requests")))


def merge_request_windows(parts: DataFrame, by: tuple[str, ...] = ("pool_name",)) -> DataFrame:
    """A2 + O1 from partial rows (one or many per extract and key)."""
    return _finish_window(merge_window_parts(parts, by), list(by))


def _finish_window(agg: DataFrame, by: list[str]) -> DataFrame:
    return (agg
            .select(*by, "extract_ts", "min_request_start_time", "max_start_time",
                    whole_units("MINUTE", "min_request_start_time", "max_start_time")
                    .alias("extract_window_minutes"),
                    whole_units("HOUR", "min_request_start_time", "max_start_time")
                    .alias("extract_window_hours"),
                    "num_requests")
            .orderBy(F.col("extract_ts").desc(), *[F.col(c).asc() for c in by]))


def request_window(requests: DataFrame, by: tuple[str, ...] = ("pool_name",)) -> DataFrame:
    """A2 + O1: per extract and pool, the captured span of request start
    times, its whole minutes and hours, and the number of requests; newest
    extract first, then pool name.  ``by`` may add keys (e.g. the workspace)."""
    return _finish_window(request_window_parts(requests, by), list(by))


def latest_request_window(requests: DataFrame) -> DataFrame:
    """O2: the first row of the request window (latest extract, first pool).
    Spark plans order-by + limit as a top-k, one bounded heap per task."""
    return request_window(requests).limit(1)


def command_mix(classified: DataFrame, type_col: str = "command_type") -> DataFrame:
    """Statement mix: number of requests per statement type and pool."""
    return (classified.groupBy("pool_name", type_col)
            .agg(F.count(F.lit(1)).alias("num_requests")))


def storage_by_node(partition_stats: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A1: reserved and used space per node in MB, from page counts
    (sum of pages times 8 KB, integer-divided by 1024); ``by`` adds keys such
    as workspace and pool."""
    mb = lambda c: F.expr(f"(sum({c}) * {PAGE_KB}) div 1024")
    return (partition_stats
            .groupBy(*by, F.col("pdw_node_id").alias("node_id"))
            .agg(mb("reserved_page_count").alias("ReservedSpaceMB"),
                 mb("used_page_count").alias("UsedSpaceMB")))


def service_tiers(objectives: DataFrame, databases: DataFrame) -> DataFrame:
    """Inner join of service objectives to databases on database_id,
    reported as Database, Edition, Service Objective.  Spark picks the join
    from the sizes it measures."""
    dbs = databases.select("database_id", F.col("name").alias("Database"))
    joined = objectives.join(dbs, "database_id", "inner")
    return joined.select("Database",
                         F.col("edition").alias("Edition"),
                         F.col("service_objective").alias("Service Objective"))


def databases_by_collation(databases: DataFrame) -> DataFrame:
    """A5: databases grouped by collation (a null collation is a group).

    Kept relational - one row per database with its collation and the size
    of its collation group - so no group is ever gathered into one value.
    The per-collation counts come from a partial aggregate and are joined
    back; Spark picks the join from the sizes it measures.
    """
    counts = (databases.groupBy(F.col("collation_name").alias("_collation"))
              .agg(F.count(F.lit(1)).alias("databases_in_collation")))
    names = databases.select("collation_name", "name")
    joined = names.join(counts, F.col("collation_name").eqNullSafe(F.col("_collation")), "inner")
    return joined.select("collation_name", "name", "databases_in_collation")


def dataset_profile(datasets: dict[str, DataFrame]) -> DataFrame:
    """K6 / A4: row count of every dataset, one row per dataset."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("dataset"), "row_count")
             for name, df in datasets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


PREVIEW_ROWS = 16


def dataset_preview(datasets: dict[str, DataFrame | tuple[DataFrame, Column]], rows: int = PREVIEW_ROWS) -> DataFrame:
    """K6: the row count of every dataset and up to ``rows`` of its rows, from one
    scan each: ``dataset, row_count, preview_hash, preview`` (JSON), one row per
    preview row (one with nulls for an empty dataset).

    Every row is dealt by its hash to one of ``rows`` classes, and each class keeps
    its count and the row of the smallest hash: a sample that doesn't depend on how
    the rows lie, mergeable, and never larger than ``rows`` rows in any task.  A
    dataset may come with its own hash text (a column of hex digits)."""
    parts = []
    for name, df in datasets.items():
        df, order = df if isinstance(df, tuple) else (df, None)
        if order is None:
            plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
            order = F.lpad(F.hex(F.xxhash64(*plain)), 16, "0")
        held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), order.alias("_hash"))
        dealt = F.conv(F.substring("_hash", 1, 4), 16, 10).cast("int") % rows
        # the sketch makes the aggregate an object hash aggregate: without it rows would be sorted by class
        best = held.groupBy(dealt.alias("_class")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_hash").alias("preview_hash"), F.min_by("_row", "_hash").alias("_row"),
            F.hll_sketch_agg("_hash", F.lit(8)).alias("_distinct"))
        total = best.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                         F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("_distinct")), F.lit(0)).alias("distinct_rows"),
                         F.collect_list(F.struct("preview_hash", F.to_json("_row").alias("preview"))).alias("_kept"))   # `rows` at most
        parts.append(total.select(F.lit(name).alias("dataset"), "row_count", "distinct_rows", F.inline_outer("_kept")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
