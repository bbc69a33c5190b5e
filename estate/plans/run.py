"""Profile runs: one workspace or many in one Spark job per dataset.

The reference runs the extract once per workspace (three at a time) and pool
by pool.  Here workspaces, pools and days are columns: the raw relations of
every workspace arrive as one DataFrame with a ``workspace_name`` column
(and ``pool_name`` for pool data), each dataset is staged once, partitioned
by workspace and pool, and

* catalog and storage snapshots replace the partitions (workspace, pool) of
  the pools in the run, also those that have no rows any more;
* activity datasets append the rows above each (workspace, pool) mark as a batch
  whose rows, marks and report partials become visible in one commit;
* listings, run history and metrics are restartable steps, one for each
  workspace (and day, or pool), skipped when done.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estate.functions.sqltext import redact
from estate.operators import analysis, filters, incremental, metrics, pages
from estate.sources import activity, batches, jdbc, staging

# fixed values: group folders of the staged layout
DEDICATED = "sqlpools-dedicated"
SERVERLESS = "sqlpools-serverless"
WORKSPACE = "workspace"
METRICS = "monitoring_metrics"

# fixed values: staged metric datasets and their partition columns
METRIC_DATASETS = {
    "workspace_level_metrics": ("workspace_name",),
    "dedicated_sql_pool_metrics": ("workspace_name", "pool_name"),
    "spark_pool_metrics": ("workspace_name", "pool_name"),
}

BY_POOL = ("workspace_name", "pool_name")
WINDOW_PARTS = "request_window_parts"   # partial A2 rows of each appended batch
KEYS = ["workspace_name", "pool_name"]


@dataclass
class ProfileInputs:
    """Raw relations of a profile run; any may be missing."""
    # dedicated pools
    requests: DataFrame | None = None
    sessions: DataFrame | None = None
    catalog: dict[str, DataFrame] = field(default_factory=dict)   # tables, columns, views, routines
    pools: DataFrame | None = None      # workspace_name, pool_name of the pools in the run (default: those with rows)
    partition_stats: DataFrame | None = None
    # serverless pool
    serverless_sessions: DataFrame | None = None
    serverless_requests: DataFrame | None = None
    query_stats: DataFrame | None = None
    sql_texts: DataFrame | None = None
    requests_history: DataFrame | None = None
    data_processed: DataFrame | None = None
    databases: DataFrame | None = None
    serverless_catalog: dict[str, DataFrame] = field(default_factory=dict)   # with table_catalog
    # workspace API dumps: one DataFrame for all, or one per dataset (each with its own item schema)
    listing_dumps: DataFrame | dict[str, DataFrame] | None = None
    zones: DataFrame | None = None      # workspace_name, time_zone: run history is cut to each one's local days
    # metric dataset name -> dumped responses; names as in METRIC_DATASETS
    metric_responses: dict[str, DataFrame] = field(default_factory=dict)


@dataclass
class ProfileSettings:
    redact_sql_text: bool = False
    keep_clear_login: bool = True
    mark_scope: str = "key"            # "global" reproduces one mark for all pools
    run_ts: _dt.datetime | None = None
    history_days: int = 59              # local days of run history before the run's day (with zones)
    compact_max_batches: int | None = 64    # merge the small batches of a dataset past this many
    keep_report: bool = True            # keep partial request windows of each run
    lateness: str | None = None         # e.g. '10 minutes': re-read requests that finished late (T2)
    include_databases: tuple = ()       # scope of the serverless catalog and database list (P7)
    exclude_databases: tuple = ()
    pool_allow_list: tuple = ()         # pools to profile; empty: all (P8)


def request_windows(spark: SparkSession, root: str) -> DataFrame | None:
    """A2 + O1 per workspace, extract and pool, merged from the partial rows
    every run staged - no rescan of the staged requests."""
    parts = staging.read(spark, os.path.join(root, DEDICATED), WINDOW_PARTS)
    return None if parts is None else analysis.merge_request_windows(parts, BY_POOL)


def _snapshots(out, frames: dict[str, DataFrame], group: str, pools: DataFrame | None, redact_text: bool) -> None:
    """Catalog relations of one group, replaced for every pool in the run."""
    if pools is None and frames:
        keys = [df.select(*KEYS) for df in frames.values()]
        pools = keys[0]
        for k in keys[1:]:
            pools = pools.unionByName(k)
    for name, df in frames.items():
        if redact_text:
            df = redact(df, "view_definition", "routine_definition")
        key = name if group.endswith(DEDICATED) else f"serverless_{name}"
        out[key] = staging.replace_partitions(df, group, name, BY_POOL, pools)


def _append(spark, out, key, raw, group, dataset, col, staged_form, s: "ProfileSettings", run_id: str) -> None:
    """One incremental dataset: the rows above the marks as one batch, with its
    marks and, for dedicated requests, the partials of the kept report."""
    marks = batches.marks(spark, group, dataset, col, KEYS, s.mark_scope)
    if s.lateness and marks is not None:
        lowered = marks.withColumn(incremental.MARK, F.col(incremental.MARK) - F.expr(f"INTERVAL {s.lateness}"))
        new = staged_form(raw, lowered)
        if "request_id" in new.columns:
            new = incremental.not_staged(new, staging.read(spark, group, dataset), col, marks,
                                         [*KEYS, "request_id"], KEYS, s.lateness)
    else:
        new = staged_form(raw, marks)
    reports = {WINDOW_PARTS: lambda rows: analysis.request_window_parts(rows, BY_POOL)} \
        if key == "session_requests" and s.keep_report else {}
    out[key] = batches.append(spark, group, dataset, new, col, KEYS, BY_POOL, run_id, reports)


def _compact(spark, group: str, dataset: str, max_batches: int) -> None:
    batches.compact(spark, group, dataset, max_batches, BY_POOL)
    batches.compact(spark, group, dataset + batches.MARKS, max_batches, merge=batches.merged_marks(KEYS))
    if dataset == "session_requests" and group.endswith(DEDICATED):
        batches.compact(spark, group, WINDOW_PARTS, max_batches, merge=lambda df: analysis.merge_window_parts(df, BY_POOL))
    batches.compact_log(spark, group)


def _with_keys(wanted: list[tuple]) -> list[tuple]:
    """The keys asked for of every dataset (workspaces, and days), in one pass."""
    if not wanted:
        return []
    asked = [keys.select(F.lit(name).alias("_dataset"), *[F.col(c) if c in by else F.lit(None).cast("date").alias(c)
                                                          for c in ("workspace_name", "last_upd")]) for name, _, by, keys in wanted]
    found: dict[str, list[dict]] = {name: [] for name, *_ in wanted}
    for r in jdbc.union_by_position(asked).distinct().collect():
        found[r["_dataset"]].append(r.asDict())
    return [(name, rows, by, [{c: k[c] for c in by} for k in found[name]]) for name, rows, by, _ in wanted]


def _asked_days(dump: DataFrame, zones: DataFrame | None, s: "ProfileSettings") -> DataFrame:
    """Run-history pages of the local days that a run asks for (P10): in each
    workspace's zone, those before the day on which the run takes place there."""
    if zones is None:
        return dump
    now = s.run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return filters.in_local_window(dump, filters.local_windows(zones, now, s.history_days), "day")


def _listing(dumps, dataset: str) -> DataFrame | None:
    if isinstance(dumps, dict):
        return dumps.get(dataset)
    return dumps.filter(F.col("dataset") == dataset)


def run_all(spark: SparkSession, root: str, inputs: ProfileInputs,
            settings: ProfileSettings | None = None) -> dict[str, int | None]:
    """Stage every available dataset for all workspaces under ``root``;
    return rows written per dataset (``None`` when a step was skipped)."""
    s = settings or ProfileSettings()
    out: dict[str, int | None] = {}
    ded = os.path.join(root, DEDICATED)
    srv = os.path.join(root, SERVERLESS)

    run_id = f"run-{uuid.uuid4().hex[:12]}"
    if s.pool_allow_list:
        inputs = replace(inputs, **{n: filters.in_scope(getattr(inputs, n), "pool_name", s.pool_allow_list)
                                    for n in ("requests", "sessions", "partition_stats", "pools")
                                    if getattr(inputs, n) is not None},
                         catalog={n: filters.in_scope(df, "pool_name", s.pool_allow_list)
                                  for n, df in inputs.catalog.items()})

    # -- dedicated pools: catalog and storage snapshots (replaced per pool)
    _snapshots(out, inputs.catalog, ded, inputs.pools, s.redact_sql_text)
    if inputs.partition_stats is not None:
        by = tuple(c for c in BY_POOL if c in inputs.partition_stats.columns)
        info = activity.stamp(analysis.storage_by_node(inputs.partition_stats, by), s.run_ts)
        out["storage_info"] = staging.write(info, ded, "storage_info", mode="overwrite",
                                            partition_by=by)

    # -- activity (incremental append above each workspace-pool mark):
    #    (output key, input, group folder, dataset, mark column, staged form)
    activity_steps = [
        ("sessions", inputs.sessions, ded, "sessions", "login_time",
         lambda raw, m: activity.dedicated_sessions(raw, marks=m, keys=KEYS, run_ts=s.run_ts,
                                                    keep_clear=s.keep_clear_login)),
        ("session_requests", inputs.requests, ded, "session_requests", "end_time",
         lambda raw, m: activity.dedicated_requests(raw, redact_text=s.redact_sql_text, marks=m,
                                                    keys=KEYS, run_ts=s.run_ts)),
        ("serverless_sessions", inputs.serverless_sessions, srv, "sessions",
         "last_request_start_time",
         lambda raw, m: activity.serverless_sessions(raw, marks=m, keys=KEYS,
                                                     keep_clear=s.keep_clear_login)),
        ("serverless_requests", inputs.serverless_requests, srv, "session_requests", "start_time",
         lambda raw, m: activity.serverless_requests(raw, marks=m, keys=KEYS)),
        ("query_stats", inputs.query_stats if inputs.sql_texts is not None else None, srv,
         "query_stats", "last_execution_time",
         lambda raw, m: activity.query_statements(raw, inputs.sql_texts, marks=m, keys=KEYS)),
        ("requests_history", inputs.requests_history, srv, "requests_history", "end_time",
         lambda raw, m: activity.requests_history(raw, marks=m, keys=KEYS)),
    ]
    appended = []
    for key, raw, group, dataset, col, staged_form in activity_steps:
        if raw is not None:
            _append(spark, out, key, raw, group, dataset, col, staged_form, s, run_id)
            appended.append((group, dataset))

    # -- serverless snapshots
    scope = {"include": s.include_databases, "exclude": s.exclude_databases}
    _snapshots(out, {n: filters.in_scope(df, "table_catalog", **scope) for n, df in inputs.serverless_catalog.items()},
               srv, inputs.pools, s.redact_sql_text)
    if inputs.databases is not None:
        out["databases"] = staging.write(filters.in_scope(inputs.databases, "name", **scope), srv, "databases", mode="overwrite",
                                         partition_by=BY_POOL)
    if inputs.data_processed is not None:
        out["data_processed"] = staging.write(activity.data_processed(inputs.data_processed),
                                              srv, "data_processed", mode="overwrite",
                                              partition_by=BY_POOL)

    # -- workspace listings, run history and metrics: a restartable step for
    #    each workspace, workspace and day, or workspace and pool
    ws, d = os.path.join(root, WORKSPACE), inputs.listing_dumps
    if d is not None:
        known = [*pages.LISTINGS, *pages.RUN_LISTINGS]
        present = set(d) if isinstance(d, dict) else {
            r.dataset for r in d.select("dataset").filter(F.col("dataset").isin(known)).distinct().collect()}
        fields = pages.listing_fields(d) if not isinstance(d, dict) and pages.drifts(d) else None
        wanted = []
        for dataset in [x for x in pages.LISTINGS if x in present]:
            dump = _listing(d, dataset)
            rows = (pages.read_listing(dump, dataset) if not pages.drifts(dump) else
                    pages.read_drifting(dump, dataset, (fields or pages.listing_fields(dump)).get(dataset, {})))
            wanted.append((dataset, filters.normalise_names(rows), ("workspace_name",), dump.select("workspace_name")))
        for dataset in [x for x in pages.RUN_LISTINGS if x in present]:
            dump = _asked_days(_listing(d, dataset), inputs.zones, s)
            rows = filters.normalise_names(pages.runs(dump, dataset))
            wanted.append((dataset, rows, ("workspace_name", "last_upd"), dump.select("workspace_name", F.col("day").alias("last_upd"))))
        out.update(staging.write_keyed_steps(spark, ws, _with_keys(wanted)))
    mon = os.path.join(root, METRICS)
    for dataset, responses in inputs.metric_responses.items():
        by = METRIC_DATASETS[dataset]
        out[dataset] = staging.write_keyed_step(spark, mon, dataset,
                                                metrics.flatten(responses, carry=by + ("resource_id",)), by, responses)
    for group in (os.path.join(root, WORKSPACE), mon):
        staging.compact_steps(spark, group)
    if s.compact_max_batches:           # hourly appends: keep batches and files bounded
        for group_root, dataset in appended:
            _compact(spark, group_root, dataset, s.compact_max_batches)
    return out
