"""Named assessment queries over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame.  The relation
builders of :mod:`estate.sources.tables` shape driver rows into assessment
inputs; the query then runs the library's operators on all of them.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate import schemas
from estate.operators import analysis, chains, filters, incremental, metrics, pages
from estate.operators.joins import materialized
from estate.plans import catalog, run
from estate.session import fresh_root
from estate.sources import activity, batches, dumps, jdbc, staging, tables
from estate.streaming import incremental as stream_inc

# Fixed extract time used where a query stamps rows (F9), so that results
# are reproducible.
RUN_TS = _dt.datetime(2024, 2, 1, 6, 0, 0)


def staged_requests(spark: SparkSession, sf_dir: str, redact_text: bool = False) -> DataFrame:
    """Requests as the dedicated extract stages them."""
    return activity.dedicated_requests(tables.requests(spark, sf_dir), redact_text=redact_text)


def request_window(spark, sf_dir):
    """Flagship: per extract and pool, captured request span and count."""
    return analysis.request_window(staged_requests(spark, sf_dir))


def latest_request_window(spark, sf_dir):
    """O2: the request window of the latest extract, first pool."""
    return analysis.latest_request_window(staged_requests(spark, sf_dir))


def command_classify(spark, sf_dir):
    """S10 (P4 + F1-F4): started requests with comments stripped and the
    statement words and type added."""
    return staged_requests(spark, sf_dir)


def redacted_requests(spark, sf_dir):
    """S10 + F10: as ``command_classify`` with the command text redacted
    after classification."""
    return staged_requests(spark, sf_dir, redact_text=True)


def command_mix(spark, sf_dir):
    """Statement mix: requests per pool and statement type."""
    return analysis.command_mix(staged_requests(spark, sf_dir))


def session_pseudonymise(spark, sf_dir):
    """S9 (P3 + F5-F9): user sessions with pseudonymised login and client."""
    return activity.dedicated_sessions(tables.sessions(spark, sf_dir), run_ts=RUN_TS)


def storage_by_node(spark, sf_dir):
    """S12 = A1 + F9: storage per node with the extract stamp."""
    return activity.stamp(analysis.storage_by_node(tables.partition_stats(spark, sf_dir)), RUN_TS)


def service_tiers(spark, sf_dir):
    """S13 = J1 + F9: service tier of every database with the extract stamp."""
    return activity.stamp(analysis.service_tiers(tables.service_objectives(spark, sf_dir),
                                                 tables.databases(spark, sf_dir)), RUN_TS)


def databases_by_collation(spark, sf_dir):
    """A5: databases in scope with their collation and its group size."""
    return analysis.databases_by_collation(databases_in_scope(spark, sf_dir))


def databases_in_scope(spark, sf_dir):
    """S4 + P2 + P7: databases without 'master' and the default exclusions."""
    dbs = filters.not_master(tables.databases(spark, sf_dir))
    return filters.in_scope(dbs, "name", exclude=filters.DEFAULT_EXCLUDED_DATABASES)


def _earlier_run(raw: DataFrame) -> DataFrame:
    """Rows an earlier extract run saw: pool n had run up to day 5 + 5n of
    the month (so that pools have different marks)."""
    pool_no = F.substring("pool_name", 6, 3).cast("int")
    return raw.filter(F.dayofmonth("start_time") < 5 + 5 * pool_no)


def _incremental(spark, sf_dir, scope):
    root = fresh_root(spark, f"incremental-{scope}")
    raw = tables.requests(spark, sf_dir)
    for seen in (_earlier_run(raw), raw):
        marks = batches.marks(spark, root, "session_requests", "end_time", ["pool_name"], scope)
        batches.append(spark, root, "session_requests", activity.dedicated_requests(seen, marks=marks),
                       "end_time", ["pool_name"], ["pool_name"])
    return staging.read(spark, root, "session_requests")


def incremental_requests(spark, sf_dir):
    """T1 with a mark per pool: stage an earlier run, then append the rows
    of a full run whose end_time lies above their pool's mark.  Marks come from
    the marks log that each batch adds to."""
    return _incremental(spark, sf_dir, "key")


def incremental_global(spark, sf_dir):
    """T1 with one mark over all pools (the reference's behaviour, D1)."""
    return _incremental(spark, sf_dir, "global")


def stream_requests(spark, sf_dir):
    """T1 as an availableNow file stream: two hourly snapshots of the source
    arrive one after the other; each start stages only what is new."""
    root = fresh_root(spark, "stream")
    source, ckpt = os.path.join(root, "source"), os.path.join(root, "_checkpoint")
    raw = tables.requests(spark, sf_dir)
    transform = lambda batch, marks: activity.dedicated_requests(batch, marks=marks)
    raw.filter(F.dayofmonth("start_time") < 15).write.mode("append").parquet(source)
    stream_inc.stream_new(spark, source, raw.schema, root, "session_requests", "end_time",
                          ckpt, transform=transform)
    raw.write.mode("append").parquet(source)
    stream_inc.stream_new(spark, source, raw.schema, root, "session_requests", "end_time",
                          ckpt, transform=transform)
    return staging.read(spark, root, "session_requests")


def stream_request_window(spark, sf_dir):
    """T1 + A2 kept incrementally: the stream of ``stream_requests`` also
    appends, per micro-batch, the partial request-window rows of the rows it
    staged; the report merges those partials instead of rescanning every
    staged request."""
    root = fresh_root(spark, "stream-report")
    source, ckpt = os.path.join(root, "source"), os.path.join(root, "_checkpoint")
    raw = tables.requests(spark, sf_dir)
    transform = lambda batch, marks: activity.dedicated_requests(batch, marks=marks)
    for snapshot in (raw.filter(F.dayofmonth("start_time") < 15), raw):
        snapshot.write.mode("append").parquet(source)
        stream_inc.stream_new(spark, source, raw.schema, root, "session_requests", "end_time",
                              ckpt, transform=transform, report="request_window_parts")
    return analysis.merge_request_windows(staging.read(spark, root, "request_window_parts"))


def staged_roundtrip(spark, sf_dir):
    """K1 + S44: stage the classified requests by pool and read them back."""
    root = fresh_root(spark, "roundtrip")
    staging.write(staged_requests(spark, sf_dir), root, "session_requests")
    return staging.read(spark, root, "session_requests")


def step_skip(spark, sf_dir):
    """K2-K4: the same step run twice writes once."""
    root = fresh_root(spark, "steps")
    fn = lambda: staged_requests(spark, sf_dir)
    first = staging.write_step(spark, root, "session_requests", fn)
    second = staging.write_step(spark, root, "session_requests", fn)
    if first is None or second is not None:
        raise RuntimeError(f"step state broken: first={first} second={second}")
    return staging.read(spark, root, "session_requests")


def analyzer_views(spark, sf_dir):
    """K5: stage dedicated-pool datasets, register the analyzer schema and
    answer the request-window question from its relation."""
    ws_root = fresh_root(spark, "analyzer")
    group = os.path.join(ws_root, catalog.CATEGORIES["dedicated"])
    staging.write(staged_requests(spark, sf_dir), group, "session_requests")
    staging.write(activity.dedicated_sessions(tables.sessions(spark, sf_dir), run_ts=RUN_TS),
                  group, "sessions")
    schema = "estate_analyzer"
    catalog.register_views(spark, ws_root, schema)
    return analysis.request_window(spark.table(f"{schema}.dedicated_session_requests"))


def page_chain(spark, sf_dir):
    """S38 + S39 + P1: follow the page chains of every workspace and day,
    flatten the objects, drop the price field."""
    reached = pages.reachable_pages(tables.item_pages(spark, sf_dir))
    out = pages.flatten(reached, remove=["retail_price"], carry=("workspace_name", "day", "page_no"))
    return _day_as_midnight(out, "day")


def first_pages(spark, sf_dir):
    """The objects of page 1 of every chain (the older single request)."""
    out = pages.first_page(tables.item_pages(spark, sf_dir), "pipelines", keep=["id", "name", "size"])
    return out.drop("dataset")


def listing_flatten(spark, sf_dir):
    """S24 + S39 + P1: the sql_pools listing with its default keep-list."""
    pools = pages.read_listing(tables.pool_pages(spark, sf_dir), "sql_pools")
    return pools.select("workspace_name", "id", "name", "type", "location",
                        F.col("sku.name").alias("sku_name"),
                        F.col("sku.capacity").alias("sku_capacity"),
                        "provisioning_state", "status", "creation_date")


def online_pools(spark, sf_dir):
    """P8 + P9: pools to profile - allow-list (empty: all), status Online."""
    pools = pages.read_listing(tables.pool_pages(spark, sf_dir), "sql_pools")
    pools = filters.online(filters.in_scope(pools, "name", include=[]))
    return pools.select("id", "name", "status", F.col("sku.name").alias("sku_name"))


RUN_DATE = _dt.date(2001, 6, 15)
RUN_TZ = "America/New_York"


def runs_by_day(spark, sf_dir):
    """S35 + P10: pipeline runs of the 59 local days before the run date in
    the workspace time zone, with the local day as ``last_upd`` (reported as
    the day's midnight, a timestamp without time zone)."""
    runs = filters.day_partitions(tables.pipeline_runs(spark, sf_dir), "last_updated",
                                  RUN_TZ, RUN_DATE, days=59)
    return _day_as_midnight(runs)


def _day_as_midnight(df, col="last_upd"):
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


def runs_staged(spark, sf_dir):
    """S35 + P10 + K3: the 59 run-history days staged as restartable day
    partitions in one write; a second run finds every day done and writes
    nothing; the staged runs are read back."""
    root = fresh_root(spark, "runs")
    runs = filters.day_partitions(tables.pipeline_runs(spark, sf_dir), "last_updated",
                                  RUN_TZ, RUN_DATE, days=59)
    days = filters.day_list(RUN_DATE, 59)
    staging.write_partition_steps(spark, root, "pipeline_runs", runs, "last_upd", days)
    again = staging.write_partition_steps(spark, root, "pipeline_runs", runs, "last_upd", days)
    if again:
        raise RuntimeError(f"day steps re-ran: {sorted(again)[:3]}")
    return _day_as_midnight(staging.read(spark, root, "pipeline_runs",
                                         partition_types={"last_upd": T.DateType()}))


def incremental_late(spark, sf_dir):
    """T1 + T2: like ``incremental_requests``, but one request in seven was
    still running in the earlier run and has finished since; the mark is lowered
    by ten minutes to pick up what finished late, rows already staged in the
    same version are left out, and a request staged twice shows its newest
    version (per pool and request)."""
    root = fresh_root(spark, "late")
    raw = tables.requests(spark, sf_dir)
    running = F.when(F.col("request_id") % 7 == 3, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("end_time"))
    append = lambda df: batches.append(spark, root, "session_requests", df, "end_time", ["pool_name"], ["pool_name"])
    append(activity.dedicated_requests(_earlier_run(raw).withColumn("end_time", running)))
    staged = staging.read(spark, root, "session_requests")
    marks = batches.marks(spark, root, "session_requests", "end_time", ["pool_name"])
    late = "10 minutes"
    new = incremental.newer_than(activity.dedicated_requests(raw), "end_time", marks, lateness=late)
    new = incremental.not_staged(new, staged, "end_time", marks, ["pool_name", "request_id"], lateness=late)
    append(new)
    return incremental.keep_newest(staging.read(spark, root, "session_requests"),
                                   ["pool_name", "request_id"], "end_time")


def staged_listings(spark, sf_dir):
    """S24 + S38 + S39 + K2 from dump files: the pool listing is dumped as JSON
    lines, read back with its declared schema, staged by the profile run as
    a restartable step (chain cut, flatten, keep-list, names normalised) and
    read from the staged folder."""
    root = fresh_root(spark, "listings")
    dump_dir = os.path.join(root, "_dumps", "sql_pools")
    dumps.write_dump(tables.pool_pages(spark, sf_dir), dump_dir)
    listing = dumps.read_pages(spark, dump_dir, schemas.SQL_POOL)
    run.run_all(spark, root, run.ProfileInputs(listing_dumps=listing))
    pools = staging.read(spark, os.path.join(root, run.WORKSPACE), "sql_pools")
    return pools.select("workspace_name", "id", "name", "type", "location",
                        F.col("sku.name").alias("sku_name"),
                        F.col("sku.capacity").alias("sku_capacity"),
                        "provisioning_state", "status", "creation_date")


def _report(points, digits=4):
    """Metric points as reported: extremes and totals rounded to ``digits``
    decimals, and the average derived from the rounded total
    (``total / count``), so the three agree with each other and a value
    lying exactly between two roundings cannot flip."""
    total = F.round("total", digits)
    return points.select(
        *[c for c in points.columns if c not in ("average", "maximum", "minimum", "total")],
        (total / F.col("count")).alias("average"),
        F.round("maximum", digits).alias("maximum"),
        F.round("minimum", digits).alias("minimum"),
        total.alias("total"))


def metric_flatten(spark, sf_dir):
    """Flatten dumped metric responses to one row per point."""
    return _report(metrics.flatten(tables.metric_responses(spark, sf_dir)))


def metric_rollup_15m(spark, sf_dir):
    """S41 + A6 + P12: dedicated-pool metrics, 90 days, 15-minute grain."""
    return _report(metrics.profile(tables.metric_points(spark, sf_dir), "dedicated"))


def metric_rollup_1h(spark, sf_dir):
    """S43 + A6 + P12: workspace metrics, 90 days, 1-hour grain."""
    return _report(metrics.profile(tables.metric_points(spark, sf_dir), "workspace"))


def metric_coarsen(spark, sf_dir):
    """S42 from dumps: Spark-pool metric points flattened from 15-minute
    responses and rolled up to the hour."""
    pts = metrics.flatten(tables.metric_responses(spark, sf_dir))
    pts = pts.filter(F.col("name").isin(*metrics.SPARK_POOL_METRICS))
    return _report(metrics.coarsen(pts, "1 hour"))


def union_databases(spark, sf_dir):
    """S4 + U1: the catalog rows of all listed databases (one per part type)
    with the database name, from one scan."""
    part = tables.table(spark, sf_dir, "part")
    rows = part.select(F.lower("p_type").alias("table_catalog"), F.col("p_brand").alias("table_schema"),
                       F.col("p_name").alias("table_name"), F.col("p_size").alias("table_size"))
    listed = part.select(F.lower("p_type").alias("name")).distinct()
    return jdbc.scan_databases(rows, listed)


def listings_by_workspace(spark, sf_dir):
    """K2 + U3: the pool listing staged by two profile runs, the first of one
    workspace, the second of all three: a step for each workspace."""
    root = fresh_root(spark, "listings-ws")
    dump = tables.pool_pages(spark, sf_dir)
    others = dump.withColumn("dataset", F.concat(F.lit("other_"), F.col("page_no").cast("string")))
    for part in (dump.filter("workspace_name = 'ws_0'"), dump.unionByName(others)):
        run.run_all(spark, root, run.ProfileInputs(listing_dumps=part))
    pools = staging.read(spark, os.path.join(root, run.WORKSPACE), "sql_pools")
    return pools.select("workspace_name", "id", "name", "type", "location",
                        F.col("sku.name").alias("sku_name"),
                        F.col("sku.capacity").alias("sku_capacity"),
                        "provisioning_state", "status", "creation_date")


def run_history(spark, sf_dir):
    """S35 + S36 + K3 from a profile run: pipeline and trigger runs of the 59
    run-history days staged by workspace and day, the first run with one
    workspace, the second with all."""
    root = fresh_root(spark, "run-history")
    asked = F.col("day").isin(filters.day_list(RUN_DATE, 59))
    dumps = {d: materialized(tables.run_pages(spark, sf_dir, d).filter(asked)) for d in pages.RUN_LISTINGS}
    for only in ("workspace_name = 'ws_0'", "true"):
        run.run_all(spark, root, run.ProfileInputs(listing_dumps={d: x.filter(only) for d, x in dumps.items()}))
    days = {"last_upd": T.DateType()}
    staged = [staging.read(spark, os.path.join(root, run.WORKSPACE), d, partition_types=days)
              .select(F.lit(d).alias("dataset"), "workspace_name", "last_upd", "run_id", "pipeline_name", "status")
              for d in pages.RUN_LISTINGS]
    return _day_as_midnight(staged[0].unionByName(staged[1]))


def metric_spark_15m(spark, sf_dir):
    """S42 + A6 + P12: Spark-pool metrics, 90 days, 15-minute grain."""
    return _report(metrics.profile(tables.metric_points(spark, sf_dir), "spark"))


def request_json(spark, sf_dir):
    """one JSON text per request (id, pool and statement type)."""
    rows = staged_requests(spark, sf_dir).select("request_id", "pool_name", "command_type")
    return staging.to_json_lines(rows)


def query_statements(spark, sf_dir):
    """S20 = J2 + F11: statistics joined to their batch texts, statement cut
    out by offsets."""
    return activity.query_statements(tables.statement_stats(spark, sf_dir),
                                     tables.statement_texts(spark, sf_dir))


def dataset_profile(spark, sf_dir):
    """K6 / A4: row count of every driver table."""
    return analysis.dataset_profile({t: tables.table(spark, sf_dir, t) for t in tables.TABLES})


def multi_workspace_window(spark, sf_dir):
    """U3 + T1 + A2: three workspaces profiled together by one profile run,
    twice (an earlier run, then a full one appending above each
    workspace-pool mark), then the request window per workspace, extract and
    pool from the staged data."""
    root = fresh_root(spark, "multi")
    raw = tables.requests(spark, sf_dir, with_workspace=True)
    run.run_all(spark, root, run.ProfileInputs(requests=_earlier_run(raw)))
    run.run_all(spark, root, run.ProfileInputs(requests=raw))
    staged = staging.read(spark, os.path.join(root, run.DEDICATED), "session_requests")
    return analysis.request_window(staged, by=("workspace_name", "pool_name"))


def serverless_sessions(spark, sf_dir):
    """S18 = P5 + F5-F7: user-process sessions of the built-in pool,
    pseudonymised (the client id stays, as in the source)."""
    return activity.serverless_sessions(tables.sessions(spark, sf_dir, serverless=True))


def linked_page_chain(spark, sf_dir):
    """S38 + S39: pages that know tokens only, followed from the page that was
    asked for without one; their objects with the page's place in its chain."""
    reached = chains.linked_pages(tables.token_pages(spark, sf_dir))
    return _day_as_midnight(pages.flatten(reached, keep=["id", "name", "size"], carry=("workspace_name", "day", "page_no")), "day")


def drifting_listings(spark, sf_dir):
    """S23-S34 + K2: all twelve listings, whose objects differ in shape between
    workspaces, staged by a profile run with columns typed over all of them; per
    dataset, workspace and field the column type, its values and the greatest."""
    root = fresh_root(spark, "drifting")
    dump_dir = os.path.join(root, "_dumps", "listings")
    dumps.write_dump(tables.listing_dumps(spark, sf_dir), dump_dir)
    run.run_all(spark, root, run.ProfileInputs(listing_dumps=dumps.read_drifting_pages(spark, dump_dir)))
    out = []
    for dataset in pages.LISTINGS:
        df = staging.read(spark, os.path.join(root, run.WORKSPACE), dataset)
        if df is not None:
            types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            fields = F.array(*[F.struct(F.lit(c).alias("field"), F.lit(t).alias("type"), F.col(c).cast("string").alias("v"))
                               for c, t in types.items() if c not in ("workspace_name", "dataset")])
            out.append(df.select(F.lit(dataset).alias("dataset"), "workspace_name", F.inline(fields))
                       .groupBy("dataset", "workspace_name", "field", "type")
                       .agg(F.count(F.lit(1)).alias("num_recs"), F.count("v").alias("num_values"), F.max("v").alias("greatest")))
    return jdbc.union_by_position(out)


def union_by_collation(spark, sf_dir):
    """U1 + X3 + A5: the catalog views of all databases of a server, which differ in
    column names and types, united per collation by position."""
    listed, view = tables.sql_databases(spark, sf_dir)
    return jdbc.union_by_collation(view, listed)


ZONED_RUN = _dt.datetime(2001, 4, 21, 2, 30)      # the day before in New York; both 2001 clock changes lie in the span


def zoned_run_history(spark, sf_dir):
    """S35 + S36 + P10 + U3: pipeline and trigger runs of three workspaces in three
    time zones, staged by profile runs that cut each one's history to its own 59
    local days."""
    root = fresh_root(spark, "zoned")
    dumped = {d: materialized(tables.zoned_run_pages(spark, sf_dir, d)) for d in pages.RUN_LISTINGS}
    settings = run.ProfileSettings(run_ts=ZONED_RUN)
    for only in ("workspace_name <> 'ws_2'", "true"):
        run.run_all(spark, root, run.ProfileInputs(listing_dumps={d: x.filter(only) for d, x in dumped.items()},
                                                   zones=tables.zones(spark)), settings)
    staged = [staging.read(spark, os.path.join(root, run.WORKSPACE), d, partition_types={"last_upd": T.DateType()})
              .select(F.lit(d).alias("dataset"), "workspace_name", "last_upd", "run_id", "status", "last_updated")
              for d in pages.RUN_LISTINGS]
    return _day_as_midnight(staged[0].unionByName(staged[1]))


def stream_late_requests(spark, sf_dir):
    """T2 on the stream: in the first snapshot one request in seven still runs; the
    second shows them finished, some below the mark.  Every request once: finished
    ones, and those that still run."""
    root = fresh_root(spark, "stream-late")
    source, ckpt = os.path.join(root, "source"), os.path.join(root, "_checkpoint")
    raw = tables.requests(spark, sf_dir)
    running = F.when(F.col("request_id") % 7 == 3, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("end_time"))
    transform = lambda batch, marks: activity.dedicated_requests(batch, marks=marks)
    for snapshot in (raw.filter(F.dayofmonth("start_time") < 15).withColumn("end_time", running), raw):
        snapshot.write.mode("append").parquet(source)
        stream_inc.stream_new(spark, source, raw.schema, root, "session_requests", "end_time", ckpt,
                              transform=transform, request_key=["pool_name", "request_id"])
    return stream_inc.current(spark, root, "session_requests")


def dataset_preview(spark, sf_dir):
    """K6: row count and sixteen rows of each table with a key, from one scan each."""
    keys = {"customer": "c_custkey", "documents": "doc_id", "events": "event_id", "orders": "o_orderkey",
            "part": "p_partkey", "supplier": "s_suppkey"}
    found = analysis.dataset_preview({t: (tables.table(spark, sf_dir, t).select(k), F.md5(F.col(k).cast("string"))) for t, k in keys.items()})
    return found.select("dataset", "row_count", "preview_hash", F.regexp_extract("preview", ":(-?[0-9]+)", 1).cast("long").alias("preview_key"))


def allowed_pools(spark, sf_dir):
    """P8 + P9 with an allow-list: the listed pools that are online."""
    pools = pages.read_listing(tables.pool_pages(spark, sf_dir), "sql_pools")
    listed = [f"supplier_{n:09d}" for n in range(0, 40, 3)]
    return filters.online(filters.in_scope(pools, "name", include=listed, exclude=listed[:1])).select("id", "name", "status")


def metric_span(spark, sf_dir):
    """P12 + A6 over years of samples (order totals as a workspace metric): the
    last 90 days at the 1-hour grain."""
    o = tables.table(spark, sf_dir, "orders")
    points = o.select(F.concat(F.lit("/ws/"), (F.col("o_custkey") % 3).cast("string")).alias("resource_id"),
                      F.lit(metrics.WORKSPACE_METRICS[0]).alias("name"),
                      F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"))
    return _report(metrics.profile(points, "workspace"))


def node_query_stats(spark, sf_dir):
    """Node query statistics (one per line item) with the extract stamp."""
    li = tables.table(spark, sf_dir, "lineitem")
    raw = li.select((F.col("l_suppkey") % 60).cast("int").alias("pdw_node_id"), F.col("l_orderkey").alias("query_hash"),
                    F.col("l_linenumber").cast("int").alias("execution_count"))
    return activity.dedicated_query_stats(raw, RUN_TS)


def serverless_activity(spark, sf_dir):
    """S19 + S21 + S22: requests, request history and data processed of the
    serverless pool, staged by two profile runs, the second appending above the
    marks of start (requests) and end (history)."""
    root = fresh_root(spark, "serverless")
    raw = tables.requests(spark, sf_dir, with_workspace=True).drop("command", "extract_ts").withColumn("pool_name", F.lit("built-in"))
    processed = raw.groupBy("workspace_name", "pool_name").agg((F.count(F.lit(1)) * 10).alias("data_processed_mb"))
    for seen in (raw.filter(F.dayofmonth("start_time") < 12), raw):
        run.run_all(spark, root, run.ProfileInputs(serverless_requests=seen, requests_history=seen, data_processed=processed))
    group = os.path.join(root, run.SERVERLESS)
    rows = [staging.read(spark, group, d).select(F.lit(d).alias("dataset"), "workspace_name", "request_id", "start_time", "end_time")
            for d in ("session_requests", "requests_history")]
    return rows[0].unionByName(rows[1]).join(staging.read(spark, group, "data_processed").drop("pool_name"), "workspace_name")


QUERIES = {
    "request_window": request_window,
    "latest_request_window": latest_request_window,
    "command_classify": command_classify,
    "redacted_requests": redacted_requests,
    "command_mix": command_mix,
    "session_pseudonymise": session_pseudonymise,
    "storage_by_node": storage_by_node,
    "service_tiers": service_tiers,
    "databases_by_collation": databases_by_collation,
    "databases_in_scope": databases_in_scope,
    "incremental_requests": incremental_requests,
    "incremental_global": incremental_global,
    "stream_requests": stream_requests,
    "staged_roundtrip": staged_roundtrip,
    "step_skip": step_skip,
    "analyzer_views": analyzer_views,
    "page_chain": page_chain,
    "listing_flatten": listing_flatten,
    "online_pools": online_pools,
    "runs_by_day": runs_by_day,
    "metric_flatten": metric_flatten,
    "metric_rollup_15m": metric_rollup_15m,
    "metric_rollup_1h": metric_rollup_1h,
    "metric_coarsen": metric_coarsen,
    "union_databases": union_databases,
    "query_statements": query_statements,
    "dataset_profile": dataset_profile,
    "multi_workspace_window": multi_workspace_window,
    "serverless_sessions": serverless_sessions,
    "runs_staged": runs_staged,
    "incremental_late": incremental_late,
    "staged_listings": staged_listings,
    "stream_request_window": stream_request_window,
    "first_pages": first_pages,
    "listings_by_workspace": listings_by_workspace,
    "run_history": run_history,
    "metric_spark_15m": metric_spark_15m,
    "request_json": request_json,
    "linked_page_chain": linked_page_chain,
    "drifting_listings": drifting_listings,
    "union_by_collation": union_by_collation,
    "zoned_run_history": zoned_run_history,
    "stream_late_requests": stream_late_requests,
    "dataset_preview": dataset_preview,
    "allowed_pools": allowed_pools,
    "metric_span": metric_span,
    "node_query_stats": node_query_stats,
    "serverless_activity": serverless_activity,
}
