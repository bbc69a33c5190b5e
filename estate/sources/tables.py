"""Driver tables and the assessment relations built from them.

The driver ships TPC-H-like tables.  The assessment works on warehouse
activity (requests, sessions, catalog rows, storage, listings, metrics), so
each relation here only *shapes* driver rows into the schema a job expects:
it renames and derives columns, row for row, and does none of the job's
work.  Every relation keeps all rows of its table, so its size grows with
the scale factor.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estate.functions.timefns import day_start, instant_from_wall, local_date

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (a parquet file per table)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pool(c: Column) -> Column:
    return F.concat(F.lit("pool_"), (c % 4).cast("string"))


def requests(spark: SparkSession, sf_dir: str, with_workspace: bool = False) -> DataFrame:
    """Raw request rows (one per event): request_id, pool_name, start_time,
    end_time, command, extract_ts.  Commands cycle through statement shapes,
    some null, some with comments; one in eleven is still running."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = eid % 16
    command = (F.when(k == 0, F.lit(None).cast("string"))
               .when(k == 1, F.concat(F.lit("/* j */ select * from t"), eid.cast("string")))
               .when(k == 2, F.lit("WITH a AS (select 1 x) select x from a"))
               .when(k == 3, F.lit("-- load\nINSERT INTO dbo.f values (1)"))
               .when(k == 4, F.lit("merge into d using s"))
               .when(k == 5, F.lit("CREATE TABLE x(a int)"))
               .when(k == 6, F.lit("EXEC sp_run 1"))
               .when(k == 7, F.lit("BEGIN TRAN"))
               .when(k == 8, F.lit("END TRANSACTION"))
               .when(k == 9, F.lit("commit"))
               .when(k == 10, F.lit("Rollback tran"))
               .when(k == 11, F.lit(""))
               .when(k == 12, F.lit("(select 1)"))
               .when(k == 13, F.lit("DBCC SHOW_STATISTICS"))
               .when(k == 14, F.lit("truncate table z"))
               .otherwise(F.lit("select 1 -- tail")))
    end_time = F.when(eid % 11 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.col("ts") + F.make_dt_interval(secs=(eid % 600).cast("decimal(18,6)")))
    cols = _request_columns(command, end_time)
    if with_workspace:   # three workspaces
        cols.append(F.concat(F.lit("ws_"), (F.col("user_id") % 3).cast("string")).alias("workspace_name"))
    return ev.select(*cols)


def _request_columns(command: Column, end_time: Column) -> list[Column]:
    return [F.col("event_id").alias("request_id"),
            _pool(F.col("user_id")).alias("pool_name"),
            F.col("ts").alias("start_time"),
            end_time.alias("end_time"),
            command.alias("command"),
            day_start("ts").alias("extract_ts")]


def sessions(spark: SparkSession, sf_dir: str, serverless: bool = False) -> DataFrame:
    """Raw session rows (one per order): session_id, pool_name, login_name,
    client_id, login_time.  Logins cycle through system, person, app, short
    and null shapes."""
    o = table(spark, sf_dir, "orders")
    ck = F.col("o_custkey")
    k = ck % 6
    login = (F.when(k == 0, F.lit("System"))
             .when(k == 1, F.concat(F.lit("user"), ck.cast("string"), F.lit(".x@corp.com")))
             .when(k == 2, F.concat(F.lit("app"), ck.cast("string"), F.lit("-id@tenant-1")))
             .when(k == 3, F.lit("a@x.com"))
             .when(k == 4, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("Jane.Doe"), ck.cast("string"), F.lit("@corp.org"))))
    client = F.concat(F.lit("10.0."), (ck % 256).cast("string"), F.lit(":1433"))
    if serverless:   # built-in pool; user-process flag and last request time
        return o.select(F.col("o_orderkey").alias("session_id"),
                        F.lit("built-in").alias("pool_name"), login.alias("login_name"),
                        client.alias("client_id"),
                        (F.col("o_orderstatus") != "P").alias("is_user_process"),
                        F.col("o_orderdate").alias("last_request_start_time"))
    return o.select(
        F.col("o_orderkey").alias("session_id"),
        _pool(F.col("o_orderkey")).alias("pool_name"),
        login.alias("login_name"),
        client.alias("client_id"),
        F.col("o_orderdate").alias("login_time"),
    )


def partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage partition rows (one per line item): pdw_node_id,
    reserved_page_count, used_page_count."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_suppkey") % 60).cast("int").alias("pdw_node_id"),
        F.col("l_orderkey").cast("bigint").alias("reserved_page_count"),
        F.col("l_partkey").cast("bigint").alias("used_page_count"),
    )


def databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog databases (one per customer): name, database_id, collation_name,
    state_desc.  Collations are few and large (market segments), and one
    database in fifty has no collation."""
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    name = (F.when(ck == 0, F.lit("master"))
            .when(ck == 1, F.lit("default"))
            .otherwise(F.lower(F.regexp_replace("c_name", "#", "_"))))
    collation = F.when(ck % 50 == 7, F.lit(None).cast("string")).otherwise(
        F.concat(F.upper(F.substring("c_mktsegment", 1, 1)),
                 F.lower(F.substring("c_mktsegment", 2, 100)), F.lit("_CI_AS")))
    return c.select(
        name.alias("name"),
        ck.alias("database_id"),
        collation.alias("collation_name"),
        F.when(F.col("c_acctbal") >= 0, F.lit("ONLINE")).otherwise(F.lit("OFFLINE")).alias("state_desc"),
    )


def service_objectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service objective rows (one per order): database_id, edition,
    service_objective."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("database_id"),
        F.concat(F.lit("DW"), F.substring("o_orderpriority", 1, 1)).alias("edition"),
        F.concat(F.lit("DW"), ((F.col("o_orderkey") % 30 + 1) * 100).cast("string"), F.lit("c"))
        .alias("service_objective"),
    )


def item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumped listing pages (from part): three workspaces, one chain per
    workspace and day (1,800 keys a day), so the number of chains grows with the
    table; page ``n`` of a chain holds the parts with key in ``[60(n-1), 60n)``
    of the day - at most 20.  Page 25 of every second day carries no
    continuation token, page 20 of every third an empty one."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    item = F.struct(
        F.concat(F.lit("/items/"), key.cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("retail_price"),
    )
    number = F.floor(key / 1800).cast("int")
    pages = (p.select(F.concat(F.lit("ws_"), (key % 3).cast("string")).alias("workspace_name"),
                      number.alias("_number"), (F.floor((key % 1800) / 60) + 1).cast("int").alias("page_no"),
                      item.alias("item"))
             .groupBy("workspace_name", "_number", "page_no")
             .agg(F.collect_list("item").alias("value")))
    token = (F.when((F.col("_number") % 2 == 0) & (F.col("page_no") == 25), F.lit(None).cast("string"))
             .when((F.col("_number") % 3 == 0) & (F.col("page_no") == 20), F.lit(""))
             .otherwise(F.concat(F.lit("tok-"), F.col("page_no").cast("string"))))
    return pages.select(
        "workspace_name", F.lit("pipelines").alias("dataset"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("_number")).alias("day"), "page_no",
        token.alias("continuation_token"), "value")


def run_pages(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Dumped run-history pages (from orders): three workspaces, one chain per
    workspace and order day in pages of 100 runs; even keys are pipeline runs,
    odd ones trigger runs."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == (0 if dataset == "pipeline_runs" else 1))
    run = F.struct(F.col("o_orderkey").cast("string").alias("run_id"),
                   F.concat(F.lit("pl_"), F.substring("o_orderpriority", 1, 1)).alias("pipeline_name"),
                   F.col("o_orderstatus").alias("status"))
    return _paged_runs(o.select(F.concat(F.lit("ws_"), (F.col("o_custkey") % 3).cast("string")).alias("workspace_name"),
                                F.to_date("o_orderdate").alias("day"), "o_orderkey", run.alias("run")), dataset)


def _paged_runs(runs: DataFrame, dataset: str) -> DataFrame:
    order = Window.partitionBy("workspace_name", "day").orderBy("o_orderkey")
    return (runs.withColumn("page_no", F.ceil(F.row_number().over(order) / 100).cast("int"))
            .groupBy("workspace_name", "day", "page_no").agg(F.collect_list("run").alias("value"))
            .select("workspace_name", F.lit(dataset).alias("dataset"), "day", "page_no",
                    F.concat(F.lit("tok-"), F.col("page_no").cast("string")).alias("continuation_token"), "value"))


ZONES = {"ws_0": "America/New_York", "ws_1": "Europe/Berlin", "ws_2": "Asia/Kolkata"}


def zones(spark: SparkSession) -> DataFrame:
    """The time zone of each workspace."""
    return spark.createDataFrame(list(ZONES.items()), "workspace_name string, time_zone string")


def zoned_run_pages(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Dumped run-history pages as :func:`run_pages`, with the run's instant; the
    day that was asked for is the local day of the workspace's zone."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == (0 if dataset == "pipeline_runs" else 1))
    at = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    ws = F.concat(F.lit("ws_"), (F.col("o_custkey") % 3).cast("string"))
    zone = F.element_at(F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair]), F.col("workspace_name"))
    run = F.struct(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderstatus").alias("status"),
                   instant_from_wall("at").alias("last_updated"))
    runs = o.select("o_orderkey", "o_orderstatus", ws.alias("workspace_name"), at.alias("at"))
    return _paged_runs(runs.select("workspace_name", local_date("at", zone).alias("day"), "o_orderkey", run.alias("run")), dataset)


def token_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`item_pages` as the service gives them: no page numbers, but the token
    each page was asked with and the one it answered with.  Some chains end early,
    some lead back to their page 3, some name a page that nobody dumped."""
    p = item_pages(spark, sf_dir)
    number, n = F.datediff("day", F.lit("2024-01-01").cast("date")), F.col("page_no")

    def token(no):
        return F.md5(F.concat_ws("-", "workspace_name", number.cast("string"), no.cast("string")))
    answer = (F.when((number % 5 == 1) & (n == 28), token(F.lit(3)))
              .when((number % 5 == 2) & (n == 10), F.lit("gone"))
              .when(F.coalesce("continuation_token", F.lit("")) == "", F.col("continuation_token"))
              .otherwise(token(n + 1)))
    return p.select("workspace_name", "dataset", "day", F.when(n > 1, token(n)).alias("request_token"),
                    answer.alias("continuation_token"), "value")


def listing_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumped pages of all twelve listings (from part), objects as JSON text whose
    shape drifts: ``ws_1`` lacks ``size``, ``ws_2`` has it as text and has
    ``extra``; nested properties everywhere; at most 20 objects a page."""
    from estate.operators.pages import LISTINGS
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    ws, dataset = F.floor(key / len(LISTINGS)) % 3, key % len(LISTINGS)
    common = [F.concat(F.lit("/x/"), key.cast("string")).alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("type"),
              F.struct(F.col("p_brand").alias("brand"), F.array(F.col("p_size")).alias("sizes")).alias("sku")]
    text = (F.when(ws == 0, F.to_json(F.struct(*common, F.col("p_size").alias("size"))))
            .when(ws == 1, F.to_json(F.struct(*common)))
            .otherwise(F.to_json(F.struct(*common, F.col("p_size").cast("string").alias("size"), (F.col("p_size") > 25).alias("extra")))))
    per_page = 20 * 3 * len(LISTINGS)
    return (p.select(F.concat(F.lit("ws_"), ws.cast("string")).alias("workspace_name"),
                     F.element_at(F.array(*[F.lit(x) for x in LISTINGS]), (dataset + 1).cast("int")).alias("dataset"),
                     (F.floor(key / per_page) + 1).cast("int").alias("page_no"), text.alias("item"))
            .groupBy("workspace_name", "dataset", "page_no").agg(F.collect_list("item").alias("items"))
            .select("workspace_name", "dataset", F.lit(None).cast("date").alias("day"), "page_no",
                    F.concat(F.lit("tok-"), F.col("page_no").cast("string")).alias("continuation_token"),
                    F.transform("items", lambda x: F.parse_json(x)).alias("value")))


def sql_databases(spark: SparkSession, sf_dir: str):
    """One server's databases (the nations; collation: their region) with a
    catalog view each, whose columns differ in name and type from database to
    database: ``[(name, collation)], view of a name``."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    listed = [(r.n_name, r.r_name, r.n_nationkey) for r in n.select("n_name", "r_name", "n_nationkey").orderBy("n_nationkey").collect()]
    keys = {name: k for name, _, k in listed}
    rows = table(spark, sf_dir, "customer")

    def view(name: str) -> DataFrame:
        k = keys[name]
        own = rows.filter(F.col("c_nationkey") == k)
        key = F.col("c_custkey").cast("int" if k % 2 else "bigint")
        if k % 3 == 0:
            return own.select(F.col("c_custkey").cast("string").alias("object"), F.col("c_name").alias("label"))
        return own.select(key.alias("object_id" if k % 2 else "id"), F.col("c_name").alias("table_name"))
    return [(name, group) for name, group, _ in listed], view


def pool_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumped ``sql_pools`` listings (from supplier) of three workspaces;
    page ``n`` of a workspace holds the pools with key in ``[60(n-1), 60n)`` -
    at most 20.  Objects carry more fields than the listing keeps."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    pool = F.struct(
        F.concat(F.lit("/pools/"), key.cast("string")).alias("id"),
        F.lower(F.regexp_replace("s_name", "#", "_")).alias("name"),
        F.lit("warehouse/sqlPools").alias("type"),
        F.concat(F.lit("region-"), F.col("s_nationkey").cast("string")).alias("location"),
        F.struct(F.concat(F.lit("DW"), ((key % 10 + 1) * 100).cast("string"), F.lit("c")).alias("name"),
                 (key % 5).cast("int").alias("capacity")).alias("sku"),
        F.lit("Succeeded").alias("provisioning_state"),
        F.when(F.col("s_acctbal") > 0, F.lit("Online")).otherwise(F.lit("Paused")).alias("status"),
        instant_from_wall(F.lit("2020-01-01").cast("timestamp_ntz")
                          + F.make_dt_interval(days=(key % 365).cast("int"))).alias("creation_date"),
        F.col("s_acctbal").alias("max_size_bytes"),
    )
    pages = (s.select(F.concat(F.lit("ws_"), (key % 3).cast("string")).alias("workspace_name"),
                      (F.floor(key / 60) + 1).cast("int").alias("page_no"), pool.alias("pool"))
             .groupBy("workspace_name", "page_no").agg(F.collect_list("pool").alias("value")))
    return pages.select(
        "workspace_name", F.lit("sql_pools").alias("dataset"),
        F.lit(None).cast("date").alias("day"), "page_no",
        F.concat(F.lit("tok-"), F.col("page_no").cast("string")).alias("continuation_token"),
        "value")


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat pipeline-run objects (one per order): run_id, pipeline_name,
    status, last_updated (UTC wall clock, spread over the day)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("run_id"),
        F.concat(F.lit("pl_"), F.substring("o_orderpriority", 1, 1)).alias("pipeline_name"),
        F.col("o_orderstatus").alias("status"),
        (F.col("o_orderdate") + F.make_dt_interval(
            secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))).alias("last_updated"),
    )


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw metric samples (one per event): resource_id, name, ts, value.
    Names cycle through every profiled metric; error events carry a metric
    no profile asks for."""
    from estate.operators.metrics import DEDICATED_METRICS, SPARK_POOL_METRICS, WORKSPACE_METRICS
    names = list(DEDICATED_METRICS + SPARK_POOL_METRICS + WORKSPACE_METRICS)
    ev = table(spark, sf_dir, "events")
    name = F.when(F.col("event_type") == "error", F.lit("UnlistedMetric")).otherwise(
        F.element_at(F.array(*[F.lit(n) for n in names]),
                     (F.col("user_id") % len(names) + 1).cast("int")))
    return ev.select(
        F.concat(F.lit("/pools/pool_"), (F.col("user_id") % 4).cast("string")).alias("resource_id"),
        name.alias("name"), "ts", "value")


def metric_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumped metric responses: the service's 15-minute points of one
    resource and metric, one response per day - at most 96 points each."""
    from estate.operators.metrics import POINT_FIELDS, rollup
    pts = rollup(metric_points(spark, sf_dir), "15 minutes")
    point = F.struct(*[instant_from_wall("timestamp").alias("timestamp") if f == "timestamp"
                       else F.col(f) for f in POINT_FIELDS])      # the service sends instants
    per_day = (pts.groupBy("resource_id", "name", F.to_date("timestamp").alias("day"))
               .agg(F.collect_list(point).alias("data")))
    return per_day.select("resource_id", "name",
                          F.array(F.struct(F.col("data").alias("data"))).alias("timeseries"))


def statement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query statistics (one per label row): sql_handle, offsets, last
    execution time.  Rows of low-quality labels point at a handle that has
    no batch text (a negative id), as statistics of evicted plans do."""
    lb = table(spark, sf_dir, "labels")
    d = F.col("doc_id")
    return lb.select(
        F.when(F.col("quality") == 0, -d - 1).otherwise(d).alias("sql_handle"),
        (2 * (d % 10)).cast("int").alias("statement_start_offset"),
        F.when(F.col("toxic") == 1, F.lit(-1)).otherwise(2 * (d % 10 + 20)).cast("int")
        .alias("statement_end_offset"),
        (F.lit("2024-01-01").cast("timestamp_ntz")
         + F.make_dt_interval(secs=d.cast("decimal(18,6)"))).alias("last_execution_time"),
    )


def statement_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch texts (one per document): sql_handle, text."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sql_handle"), "text")
