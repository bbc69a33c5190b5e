"""Several workspaces staged by one run; a re-run appends nothing and
re-replaces snapshots; serverless and dedicated groups side by side."""

from pyspark.sql import functions as F

from estate.plans import catalog, run
from estate.sources import staging, tables

from conftest import SF_SMALL


def _ws(df, col):
    return df.withColumn("workspace_name", F.concat(F.lit("ws_"), (F.col(col) % 2).cast("string")))


def test_run_all_twice(spark, root):
    reqs = tables.requests(spark, SF_SMALL, with_workspace=True)
    sess = _ws(tables.sessions(spark, SF_SMALL), "session_id")
    srv = _ws(tables.sessions(spark, SF_SMALL, serverless=True), "session_id")
    stats = (_ws(tables.partition_stats(spark, SF_SMALL), "pdw_node_id")
             .withColumn("pool_name", F.lit("pool_0")))
    inputs = run.ProfileInputs(requests=reqs, sessions=sess, serverless_sessions=srv,
                                    partition_stats=stats)
    first = run.run_all(spark, root, inputs)
    assert first["session_requests"] > 0 and first["sessions"] > 0
    assert first["serverless_sessions"] > 0 and first["storage_info"] > 0
    again = run.run_all(spark, root, inputs)
    assert again["session_requests"] == 0 and again["sessions"] == 0
    assert again["serverless_sessions"] == 0
    ded = f"{root}/{run.DEDICATED}"
    staged = staging.read(spark, ded, "session_requests")
    assert staged.select("workspace_name").distinct().count() == 3
    assert staging.read(spark, ded, "storage_info").count() == first["storage_info"]
    made = catalog.register_views(spark, root, "estate_run_test")
    assert "estate_run_test.serverless_sessions" in made
    assert "estate_run_test.dedicated_storage_info" in made


def test_run_all_stages_metric_datasets(spark, root):
    resp = (tables.metric_responses(spark, SF_SMALL)
            .withColumn("workspace_name", F.lit("ws_0"))
            .withColumn("pool_name", F.regexp_extract("resource_id", "(pool_[0-9]+)", 1)))
    out = run.run_all(spark, root, run.ProfileInputs(metric_responses={
        "dedicated_sql_pool_metrics": resp, "workspace_level_metrics": resp}))
    assert out["dedicated_sql_pool_metrics"] == out["workspace_level_metrics"] > 0
    again = run.run_all(spark, root, run.ProfileInputs(metric_responses={
        "dedicated_sql_pool_metrics": resp}))
    assert again["dedicated_sql_pool_metrics"] is None          # step already done
    made = catalog.register_views(spark, root, "estate_metrics_test")
    assert "estate_metrics_test.metrics_dedicated_sql_pool_metrics" in made


def test_catalog_snapshots_replace_only_their_pool(spark, root):
    def views(pool, n):
        return spark.createDataFrame([("ws_0", pool, f"v{i}", f"select {i}") for i in range(n)],
                                     "workspace_name string, pool_name string, table_name string, "
                                     "view_definition string")
    run.run_all(spark, root, run.ProfileInputs(catalog={"views": views("p1", 3).unionByName(views("p2", 2))}))
    settings = run.ProfileSettings(redact_sql_text=True)
    run.run_all(spark, root, run.ProfileInputs(catalog={"views": views("p1", 1)}), settings)
    got = staging.read(spark, f"{root}/{run.DEDICATED}", "views")
    rows = sorted((r.pool_name, r.table_name, r.view_definition) for r in got.collect())
    assert rows == [("p1", "v0", "[REDACTED]"), ("p2", "v0", "select 0"), ("p2", "v1", "select 1")]


def test_run_settings(spark, root):
    reqs = tables.requests(spark, SF_SMALL, with_workspace=True)
    sess = _ws(tables.sessions(spark, SF_SMALL), "session_id")
    settings = run.ProfileSettings(redact_sql_text=True, keep_clear_login=False,
                                   mark_scope="global")
    early = reqs.filter(F.dayofmonth("start_time") < 10)
    run.run_all(spark, root, run.ProfileInputs(requests=early, sessions=sess), settings)
    out = run.run_all(spark, root, run.ProfileInputs(requests=reqs), settings)
    ded = f"{root}/{run.DEDICATED}"
    staged = staging.read(spark, ded, "session_requests")
    assert {r.command for r in staged.select("command").distinct().collect()} == {"[REDACTED]"}
    assert "login_user" not in staging.read(spark, ded, "sessions").columns
    # one mark over all workspaces and pools: only rows after the global latest end
    top = early.filter(F.col("end_time").isNotNull()).agg(F.max("end_time")).first()[0]
    later = reqs.filter(F.col("command").isNotNull() & (F.col("end_time") > F.lit(top)))
    assert out["session_requests"] == later.count()


def test_kept_report_equals_full_recount(spark, root):
    from estate.operators import analysis
    reqs = tables.requests(spark, SF_SMALL, with_workspace=True)
    run.run_all(spark, root, run.ProfileInputs(requests=reqs.filter(F.dayofmonth("start_time") < 12)))
    run.run_all(spark, root, run.ProfileInputs(requests=reqs))
    staged = staging.read(spark, f"{root}/{run.DEDICATED}", "session_requests")
    full = analysis.request_window(staged, by=("workspace_name", "pool_name"))
    kept = run.request_windows(spark, root)
    assert kept.exceptAll(full).count() == 0 and full.exceptAll(kept).count() == 0
    assert kept.count() > 0


def test_second_workspace_and_emptied_pool(spark, root):
    """Steps are per workspace and pool; a pool without rows any more is cleared."""
    def views(*pools):
        return spark.createDataFrame([("ws_0", p, f"v{i}", "select 1") for p in pools for i in range(2)],
                                     "workspace_name string, pool_name string, table_name string, view_definition string")
    pools = spark.createDataFrame([("ws_0", "a"), ("ws_0", "b")], "workspace_name string, pool_name string")
    run.run_all(spark, root, run.ProfileInputs(catalog={"views": views("a", "b")}, pools=pools))
    run.run_all(spark, root, run.ProfileInputs(catalog={"views": views("a").drop("view_definition")}, pools=pools))
    got = staging.read(spark, f"{root}/{run.DEDICATED}", "views")
    assert {r.pool_name for r in got.collect()} == {"a"} and "view_definition" in got.columns
    resp = tables.metric_responses(spark, SF_SMALL).withColumn("workspace_name", F.lit("ws_0"))
    pool = F.regexp_extract("resource_id", "(pool_[0-9]+)", 1)
    resp = resp.withColumn("pool_name", pool)
    name = "dedicated_sql_pool_metrics"
    first = run.run_all(spark, root, run.ProfileInputs(metric_responses={name: resp.filter("pool_name = 'pool_0'")}))
    second = run.run_all(spark, root, run.ProfileInputs(metric_responses={name: resp}))
    staged = staging.read(spark, f"{root}/{run.METRICS}", name)
    assert first[name] + second[name] == staged.count() and staged.select("pool_name").distinct().count() == 4


def test_running_rows_in_the_kept_report(spark, root):
    from estate.operators import analysis
    reqs = tables.requests(spark, SF_SMALL, with_workspace=True).withColumn(
        "end_time", F.when(F.col("pool_name") != "pool_1", F.col("end_time")))
    for _ in range(2):
        run.run_all(spark, root, run.ProfileInputs(requests=reqs), run.ProfileSettings(lateness="10 minutes"))
    staged = staging.read(spark, f"{root}/{run.DEDICATED}", "session_requests")
    full = analysis.request_window(staged, by=("workspace_name", "pool_name"))
    kept = run.request_windows(spark, root)
    assert kept.exceptAll(full).count() == 0 and full.exceptAll(kept).count() == 0
    done = staged.filter("end_time IS NOT NULL")
    assert done.count() == done.select("workspace_name", "pool_name", "request_id").distinct().count()
