"""DuckDB SQL for each named query (the correctness oracle).

The driver registers its tables as views; the relations of
:mod:`estate.sources.tables` are restated here as SQL so that DuckDB builds
the same inputs independently of Spark.
"""

from __future__ import annotations

import datetime as _dt

# -- fixed values, written out here so that a wrong constant of the engine shows
LINE_BLANKS = (r"[\t\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
DEDICATED_METRICS = ("DWULimit", "DWUUsed", "DWUUsedPercent", "MemoryUsedPercent",
                     "CPUPercent", "Connections", "ActiveQueries")
SPARK_POOL_METRICS = ("BigDataPoolApplicationsEnded", "BigDataPoolAllocatedCores",
                      "BigDataPoolAllocatedMemory", "BigDataPoolApplicationsActive")
WORKSPACE_METRICS = ("IntegrationActivityRunsEnded", "IntegrationPipelineRunsEnded",
                     "IntegrationTriggerRunsEnded", "BuiltinSqlPoolDataProcessedBytes",
                     "BuiltinSqlPoolLoginAttempts", "BuiltinSqlPoolRequestsEnded")
RUN_DATE = _dt.date(2001, 6, 15)
RUN_TZ = "America/New_York"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
# --


def _names(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


ALL_METRICS = DEDICATED_METRICS + SPARK_POOL_METRICS + WORKSPACE_METRICS

REQUESTS = r"""
requests AS (
  SELECT event_id AS request_id,
         concat('pool_', CAST(user_id % 4 AS VARCHAR)) AS pool_name,
         ts AS start_time,
         CASE WHEN event_id % 11 = 0 THEN NULL
              ELSE ts + to_seconds(CAST(event_id % 600 AS BIGINT)) END AS end_time,
         CASE event_id % 16
           WHEN 0 THEN NULL
           WHEN 1 THEN concat('/* j */ select * from t', CAST(event_id AS VARCHAR))
           WHEN 2 THEN 'WITH a AS (select 1 x) select x from a'
           WHEN 3 THEN concat('-- load', chr(10), 'INSERT INTO dbo.f values (1)')
           WHEN 4 THEN 'merge into d using s'
           WHEN 5 THEN 'CREATE TABLE x(a int)'
           WHEN 6 THEN 'EXEC sp_run 1'
           WHEN 7 THEN 'BEGIN TRAN'
           WHEN 8 THEN 'END TRANSACTION'
           WHEN 9 THEN 'commit'
           WHEN 10 THEN 'Rollback tran'
           WHEN 11 THEN ''
           WHEN 12 THEN '(select 1)'
           WHEN 13 THEN 'DBCC SHOW_STATISTICS'
           WHEN 14 THEN 'truncate table z'
           ELSE 'select 1 -- tail' END AS command,
         date_trunc('day', ts) AS extract_ts
  FROM events
)"""

CLASSIFIED = r"""
stripped AS (
  SELECT request_id, pool_name, start_time, end_time, extract_ts,
         regexp_replace(regexp_replace(command, '(?s)/\*.*?\*/', '', 'g'),
                        '(?m)^LINE_BLANKS*--[^\n]*', '', 'g') AS command
  FROM requests
  WHERE start_time IS NOT NULL AND command IS NOT NULL
),
worded AS (
  SELECT *, upper(regexp_extract(command, '(\w+)', 1)) AS command_w1,
            upper(regexp_extract(command, '(\w+)\s+([^\s,.]+)', 2)) AS command_w2
  FROM stripped
),
classified AS (
  SELECT *, CASE
      WHEN command_w1 IN ('SELECT', 'WITH') THEN 'QUERY'
      WHEN command_w1 IN ('INSERT', 'UPDATE', 'MERGE', 'DELETE', 'TRUNCATE', 'COPY', 'IF',
                          'BEGIN', 'DECLARE', 'BUILDREPLICATEDTABLECACHE') THEN 'DML'
      WHEN command_w1 IN ('CREATE', 'DROP', 'ALTER') THEN 'DDL'
      WHEN command_w1 IN ('EXEC', 'EXECUTE') THEN 'ROUTINE'
      WHEN command_w1 IN ('BEGIN', 'END') AND command_w2 IN ('TRAN', 'TRANSACTION')
        THEN 'TRANSACTION_CONTROL'
      WHEN command_w1 IN ('COMMIT', 'ROLLBACK') THEN 'TRANSACTION_CONTROL'
      ELSE 'OTHER' END AS command_type
  FROM worded
)"""

CLASSIFIED = CLASSIFIED.replace("LINE_BLANKS", LINE_BLANKS)

SESSIONS = r"""
sessions AS (
  SELECT o_orderkey AS session_id,
         concat('pool_', CAST(o_orderkey % 4 AS VARCHAR)) AS pool_name,
         CASE o_custkey % 6
           WHEN 0 THEN 'System'
           WHEN 1 THEN concat('user', CAST(o_custkey AS VARCHAR), '.x@corp.com')
           WHEN 2 THEN concat('app', CAST(o_custkey AS VARCHAR), '-id@tenant-1')
           WHEN 3 THEN 'a@x.com'
           WHEN 4 THEN NULL
           ELSE concat('Jane.Doe', CAST(o_custkey AS VARCHAR), '@corp.org') END AS login_name,
         concat('10.0.', CAST(o_custkey % 256 AS VARCHAR), ':1433') AS client_id,
         o_orderdate AS login_time
  FROM orders
)"""

DATABASES = r"""
databases AS (
  SELECT CASE WHEN c_custkey = 0 THEN 'master' WHEN c_custkey = 1 THEN 'default'
              ELSE lower(replace(c_name, '#', '_')) END AS name,
         c_custkey AS database_id,
         CASE WHEN c_custkey % 50 = 7 THEN NULL
              ELSE concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2, 100)),
                          '_CI_AS') END AS collation_name,
         CASE WHEN c_acctbal >= 0 THEN 'ONLINE' ELSE 'OFFLINE' END AS state_desc
  FROM customer
),
scoped AS (
  SELECT * FROM databases WHERE name <> 'master' AND name NOT IN ('default')
)"""

OBJECTIVES = r"""
objectives AS (
  SELECT o_custkey AS database_id,
         concat('DW', substr(o_orderpriority, 1, 1)) AS edition,
         concat('DW', CAST((o_orderkey % 30 + 1) * 100 AS VARCHAR), 'c') AS service_objective
  FROM orders
)"""


CLASSIFIED_COLS = ("request_id, pool_name, start_time, end_time, command, extract_ts, "
                   "command_w1, command_w2, command_type")

WINDOW = r"""
SELECT pool_name, extract_ts,
       min(start_time) AS min_request_start_time,
       max(start_time) AS max_start_time,
       date_sub('minute', min(start_time), max(start_time)) AS extract_window_minutes,
       date_sub('hour', min(start_time), max(start_time)) AS extract_window_hours,
       count(*) AS num_requests
FROM classified
GROUP BY extract_ts, pool_name"""


def _incremental(scope: str, earlier: str) -> str:
    cols = ", ".join("c." + x.strip() for x in CLASSIFIED_COLS.split(","))
    if scope == "key":
        later = f"""later AS (SELECT {cols}
          FROM classified c LEFT JOIN marks m ON c.pool_name = m.k
          WHERE m.mark IS NULL OR c.end_time > m.mark)"""
        marks = "marks AS (SELECT pool_name AS k, max(end_time) AS mark FROM earlier GROUP BY pool_name),"
    else:   # one mark over all pools, as a scalar subquery
        later = f"""later AS (SELECT {cols} FROM classified c
          WHERE (SELECT max(end_time) FROM earlier) IS NULL
             OR c.end_time > (SELECT max(end_time) FROM earlier))"""
        marks = ""
    return _with(REQUESTS, CLASSIFIED) + f""",
earlier AS (SELECT {CLASSIFIED_COLS} FROM classified WHERE {earlier}),
{marks}
{later}
SELECT * FROM earlier UNION ALL SELECT * FROM later"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLE = {
    "request_window": _with(REQUESTS, CLASSIFIED) + r"""
SELECT pool_name, extract_ts,
       min(start_time) AS min_request_start_time,
       max(start_time) AS max_start_time,
       date_sub('minute', min(start_time), max(start_time)) AS extract_window_minutes,
       date_sub('hour', min(start_time), max(start_time)) AS extract_window_hours,
       count(*) AS num_requests
FROM classified
GROUP BY extract_ts, pool_name
ORDER BY extract_ts DESC, pool_name""",

    "latest_request_window": _with(REQUESTS, CLASSIFIED) + r"""
SELECT pool_name, extract_ts,
       min(start_time) AS min_request_start_time,
       max(start_time) AS max_start_time,
       date_sub('minute', min(start_time), max(start_time)) AS extract_window_minutes,
       date_sub('hour', min(start_time), max(start_time)) AS extract_window_hours,
       count(*) AS num_requests
FROM classified
GROUP BY extract_ts, pool_name
ORDER BY extract_ts DESC, pool_name
LIMIT 1""",

    "command_classify": _with(REQUESTS, CLASSIFIED) + r"""
SELECT request_id, pool_name, start_time, end_time, command, extract_ts,
       command_w1, command_w2, command_type
FROM classified""",

    "redacted_requests": _with(REQUESTS, CLASSIFIED) + r"""
SELECT request_id, pool_name, start_time, end_time, '[REDACTED]' AS command, extract_ts,
       command_w1, command_w2, command_type
FROM classified""",

    "command_mix": _with(REQUESTS, CLASSIFIED) + r"""
SELECT pool_name, command_type, count(*) AS num_requests
FROM classified GROUP BY pool_name, command_type""",

    "session_pseudonymise": _with(SESSIONS) + r""",
typed AS (
  SELECT *, CASE WHEN nullif(trim(regexp_extract(lower(login_name),
                   '^(\w+.\w+.*)@(\w+).*(net|com|edu|org|gov)', 1)), '') IS NULL
                 THEN 'APP' ELSE 'USER' END AS login_user_type
  FROM sessions
  WHERE NOT contains(lower(login_name), 'system')
),
named AS (
  SELECT *, coalesce(nullif(trim(regexp_extract(login_name, '^(\w+)(.\w+.*)@(\w+).*', 1)), ''),
                     CASE WHEN login_user_type = 'USER' THEN 'otherUser' ELSE 'otherApp' END)
              AS login_user
  FROM typed
)
SELECT session_id, pool_name, login_time,
       TIMESTAMP '2024-02-01 06:00:00' AS extract_ts,
       login_user_type, login_user, sha256(login_user) AS login_user_sha2,
       sha256(client_id) AS client_id_sha2
FROM named""",

    "storage_by_node": r"""
SELECT CAST(l_suppkey % 60 AS INTEGER) AS node_id,
       CAST((sum(l_orderkey) * 8) // 1024 AS BIGINT) AS ReservedSpaceMB,
       CAST((sum(l_partkey) * 8) // 1024 AS BIGINT) AS UsedSpaceMB,
       TIMESTAMP '2024-02-01 06:00:00' AS extract_ts
FROM lineitem GROUP BY 1""",

    "service_tiers": _with(DATABASES, OBJECTIVES) + r"""
SELECT d.name AS "Database", o.edition AS "Edition", o.service_objective AS "Service Objective",
       TIMESTAMP '2024-02-01 06:00:00' AS extract_ts
FROM objectives o JOIN databases d ON o.database_id = d.database_id""",

    "databases_by_collation": _with(DATABASES) + r"""
SELECT collation_name, name,
       count(*) OVER (PARTITION BY collation_name) AS databases_in_collation
FROM scoped""",

    "databases_in_scope": _with(DATABASES) + r"""
SELECT name, database_id, collation_name, state_desc FROM scoped""",

    "incremental_requests": _incremental(
        "key", "day(start_time) < 5 + 5 * CAST(substr(pool_name, 6, 3) AS INTEGER)"),
    "incremental_global": _incremental(
        "global", "day(start_time) < 5 + 5 * CAST(substr(pool_name, 6, 3) AS INTEGER)"),
    "stream_requests": _incremental("key", "day(start_time) < 15"),
    "staged_roundtrip": _with(REQUESTS, CLASSIFIED) + f"""
SELECT {CLASSIFIED_COLS} FROM classified""",
    "step_skip": _with(REQUESTS, CLASSIFIED) + f"""
SELECT {CLASSIFIED_COLS} FROM classified""",
    "analyzer_views": _with(REQUESTS, CLASSIFIED) + WINDOW,
}


POINTS = f"""
points AS (
  SELECT concat('/pools/pool_', CAST(user_id % 4 AS VARCHAR)) AS resource_id,
         CASE WHEN event_type = 'error' THEN 'UnlistedMetric'
              ELSE list_extract([{_names(ALL_METRICS)}], CAST(user_id % {len(ALL_METRICS)} + 1 AS INTEGER))
         END AS name,
         ts, value
  FROM events
)"""


def _rollup(where: str, grain: str) -> str:
    return _with(POINTS) + f""",
sel AS (SELECT * FROM points WHERE {where})
SELECT resource_id, name, time_bucket(INTERVAL '{grain}', ts) AS "timestamp",
       round(sum(value), 4) / CAST(count(value) AS DOUBLE) AS average,
       CAST(count(value) AS DOUBLE) AS "count",
       round(max(value), 4) AS maximum, round(min(value), 4) AS minimum,
       round(sum(value), 4) AS total
FROM sel
GROUP BY resource_id, name, time_bucket(INTERVAL '{grain}', ts)"""


def _in_span(names, days: int) -> str:
    return (f"name IN ({_names(names)}) AND ts >= (SELECT max(ts) FROM points "
            f"WHERE name IN ({_names(names)})) - INTERVAL {days} DAY")


_FIRST_DAY = RUN_DATE - _dt.timedelta(days=59)

ORACLE.update({
    "page_chain": r"""
WITH items AS (
  SELECT concat('ws_', CAST(p_partkey % 3 AS VARCHAR)) AS workspace_name,
         p_partkey // 1800 AS num,
         CAST(((p_partkey % 1800) // 60) + 1 AS INTEGER) AS page_no,
         concat('/items/', CAST(p_partkey AS VARCHAR)) AS id,
         p_name AS name, p_type AS type, p_brand AS brand, p_size AS size
  FROM part
),
pages AS (
  SELECT DISTINCT workspace_name, num, page_no,
         NOT ((num % 2 = 0 AND page_no = 25) OR (num % 3 = 0 AND page_no = 20)) AS more
  FROM items
),
ends AS (
  SELECT p.workspace_name, p.num, min(p.page_no) AS first_page,
         min(CASE WHEN s.page_no IS NULL OR NOT p.more THEN p.page_no END) AS last_page
  FROM pages p LEFT JOIN pages s
    ON s.workspace_name = p.workspace_name AND s.num = p.num AND s.page_no = p.page_no + 1
  GROUP BY p.workspace_name, p.num
)
SELECT i.workspace_name, CAST(DATE '2024-01-01' + CAST(i.num AS INTEGER) AS TIMESTAMP) AS day, i.page_no,
       i.id, i.name, i.type, i.brand, i.size
FROM items i JOIN ends e ON i.workspace_name = e.workspace_name AND i.num = e.num
WHERE e.first_page = 1 AND i.page_no <= e.last_page""",

    "first_pages": r"""
SELECT concat('ws_', CAST(p_partkey % 3 AS VARCHAR)) AS workspace_name,
       concat('/items/', CAST(p_partkey AS VARCHAR)) AS id, p_name AS name, p_size AS size
FROM part WHERE p_partkey % 1800 < 60""",

    "run_history": f"""
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'pipeline_runs' ELSE 'trigger_runs' END AS dataset,
       concat('ws_', CAST(o_custkey % 3 AS VARCHAR)) AS workspace_name,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS last_upd, CAST(o_orderkey AS VARCHAR) AS run_id,
       concat('pl_', substr(o_orderpriority, 1, 1)) AS pipeline_name, o_orderstatus AS status
FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '{_FIRST_DAY.isoformat()}' AND CAST(o_orderdate AS DATE) < DATE '{RUN_DATE.isoformat()}'""",

    "request_json": _with(REQUESTS, CLASSIFIED) + r"""
SELECT concat('{"request_id":', request_id, ',"pool_name":"', pool_name, '"',
              CASE WHEN command_type IS NULL THEN '' ELSE concat(',"command_type":"', command_type, '"') END,
              '}') AS value
FROM classified""",

    "metric_spark_15m": _rollup(_in_span(SPARK_POOL_METRICS, 90), "15 minutes"),

    "listing_flatten": r"""
SELECT concat('ws_', CAST(s_suppkey % 3 AS VARCHAR)) AS workspace_name,
       concat('/pools/', CAST(s_suppkey AS VARCHAR)) AS id,
       lower(replace(s_name, '#', '_')) AS name,
       'warehouse/sqlPools' AS type,
       concat('region-', CAST(s_nationkey AS VARCHAR)) AS location,
       concat('DW', CAST((s_suppkey % 10 + 1) * 100 AS VARCHAR), 'c') AS sku_name,
       CAST(s_suppkey % 5 AS INTEGER) AS sku_capacity,
       'Succeeded' AS provisioning_state,
       CASE WHEN s_acctbal > 0 THEN 'Online' ELSE 'Paused' END AS status,
       TIMESTAMP '2020-01-01' + to_days(CAST(s_suppkey % 365 AS INTEGER)) AS creation_date
FROM supplier""",

    "online_pools": r"""
SELECT concat('/pools/', CAST(s_suppkey AS VARCHAR)) AS id,
       lower(replace(s_name, '#', '_')) AS name, 'Online' AS status,
       concat('DW', CAST((s_suppkey % 10 + 1) * 100 AS VARCHAR), 'c') AS sku_name
FROM supplier WHERE s_acctbal > 0""",

    "runs_by_day": f"""
WITH runs AS (
  SELECT o_orderkey AS run_id, concat('pl_', substr(o_orderpriority, 1, 1)) AS pipeline_name,
         o_orderstatus AS status,
         o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS last_updated
  FROM orders
),
d AS (
  SELECT *, CAST(timezone('{RUN_TZ}', timezone('UTC', last_updated)) AS DATE) AS last_upd
  FROM runs
)
SELECT run_id, pipeline_name, status, last_updated, CAST(last_upd AS TIMESTAMP) AS last_upd FROM d
WHERE last_upd >= DATE '{_FIRST_DAY.isoformat()}' AND last_upd < DATE '{RUN_DATE.isoformat()}'""",

    "metric_flatten": _rollup("true", "15 minutes"),
    "metric_rollup_15m": _rollup(_in_span(DEDICATED_METRICS, 90), "15 minutes"),
    "metric_rollup_1h": _rollup(_in_span(WORKSPACE_METRICS, 90), "1 hour"),
    "metric_coarsen": _rollup(f"name IN ({_names(SPARK_POOL_METRICS)})", "1 hour"),

    "union_databases": r"""
SELECT p_brand AS table_schema, p_name AS table_name, p_size AS table_size,
       lower(p_type) AS table_catalog
FROM part""",

    "query_statements": r"""
WITH stats AS (
  SELECT CASE WHEN quality = 0 THEN -doc_id - 1 ELSE doc_id END AS sql_handle,
         CAST(2 * (doc_id % 10) AS INTEGER) AS statement_start_offset,
         CAST(CASE WHEN toxic = 1 THEN -1 ELSE 2 * (doc_id % 10 + 20) END AS INTEGER)
           AS statement_end_offset,
         TIMESTAMP '2024-01-01' + to_seconds(doc_id) AS last_execution_time
  FROM labels
)
SELECT s.sql_handle, s.statement_start_offset, s.statement_end_offset, s.last_execution_time,
       substring(d.text, s.statement_start_offset // 2 + 1,
                 ((CASE WHEN s.statement_end_offset = -1 THEN 2 * length(d.text)
                        ELSE s.statement_end_offset END) - s.statement_start_offset) // 2 + 1)
         AS statement_text
FROM stats s JOIN documents d ON d.doc_id = s.sql_handle""",

    "dataset_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, count(*) AS row_count FROM {t}" for t in TABLES),
})


ORACLE.update({
    "multi_workspace_window": r"""
WITH raw AS (
  SELECT event_id, concat('ws_', CAST(user_id % 3 AS VARCHAR)) AS workspace_name FROM events
),
""" + REQUESTS.strip() + "," + CLASSIFIED + r""",
ws AS (
  SELECT c.*, r.workspace_name FROM classified c JOIN raw r ON r.event_id = c.request_id
),
earlier AS (
  SELECT * FROM ws WHERE day(start_time) < 5 + 5 * CAST(substr(pool_name, 6, 3) AS INTEGER)
),
marks AS (
  SELECT workspace_name, pool_name, max(end_time) AS mark FROM earlier
  GROUP BY workspace_name, pool_name
),
later AS (
  SELECT w.* FROM ws w LEFT JOIN marks m
    ON m.workspace_name = w.workspace_name AND m.pool_name = w.pool_name
  WHERE m.mark IS NULL OR w.end_time > m.mark
),
staged AS (SELECT * FROM earlier UNION ALL SELECT * FROM later)
SELECT workspace_name, pool_name, extract_ts,
       min(start_time) AS min_request_start_time,
       max(start_time) AS max_start_time,
       date_sub('minute', min(start_time), max(start_time)) AS extract_window_minutes,
       date_sub('hour', min(start_time), max(start_time)) AS extract_window_hours,
       count(*) AS num_requests
FROM staged
GROUP BY workspace_name, extract_ts, pool_name""",

    "serverless_sessions": _with(SESSIONS) + r""",
typed AS (
  SELECT s.*, o.o_orderstatus <> 'P' AS is_user_process,
         CASE WHEN nullif(trim(regexp_extract(lower(login_name),
                   '^(\w+.\w+.*)@(\w+).*(net|com|edu|org|gov)', 1)), '') IS NULL
              THEN 'APP' ELSE 'USER' END AS login_user_type
  FROM sessions s JOIN orders o ON o.o_orderkey = s.session_id
  WHERE o.o_orderstatus <> 'P'
)
SELECT session_id, 'built-in' AS pool_name, client_id, is_user_process,
       login_time AS last_request_start_time, login_user_type,
       coalesce(nullif(trim(regexp_extract(login_name, '^(\w+)(.\w+.*)@(\w+).*', 1)), ''),
                CASE WHEN login_user_type = 'USER' THEN 'otherUser' ELSE 'otherApp' END)
         AS login_user,
       sha256(coalesce(nullif(trim(regexp_extract(login_name, '^(\w+)(.\w+.*)@(\w+).*', 1)), ''),
                CASE WHEN login_user_type = 'USER' THEN 'otherUser' ELSE 'otherApp' END))
         AS login_user_sha2
FROM typed""",
})


ORACLE["runs_staged"] = ORACLE["runs_by_day"]
ORACLE["incremental_late"] = _with(REQUESTS, CLASSIFIED) + f""",
earlier AS (SELECT * REPLACE (CASE WHEN request_id % 7 = 3 THEN NULL ELSE end_time END AS end_time)
            FROM classified WHERE day(start_time) < 5 + 5 * CAST(substr(pool_name, 6, 3) AS INTEGER)),
marks AS (SELECT pool_name AS k, max(end_time) AS mark FROM earlier GROUP BY pool_name),
later AS (SELECT c.* FROM classified c LEFT JOIN marks m ON c.pool_name = m.k
          WHERE m.mark IS NULL OR c.end_time > m.mark - INTERVAL 10 MINUTE),
staged AS (SELECT * FROM earlier UNION ALL SELECT * FROM later)
SELECT {CLASSIFIED_COLS} FROM staged
QUALIFY row_number() OVER (PARTITION BY pool_name, request_id
                           ORDER BY end_time IS NULL, end_time DESC) = 1"""

ORACLE["listings_by_workspace"] = ORACLE["listing_flatten"]
ORACLE["staged_listings"] = ORACLE["listing_flatten"]

ORACLE["stream_request_window"] = _with(REQUESTS, CLASSIFIED) + """,
earlier AS (SELECT * FROM classified WHERE day(start_time) < 15),
marks AS (SELECT pool_name AS k, max(end_time) AS mark FROM earlier GROUP BY pool_name),
later AS (SELECT c.* FROM classified c LEFT JOIN marks m ON c.pool_name = m.k
          WHERE m.mark IS NULL OR c.end_time > m.mark),
staged AS (SELECT * FROM earlier UNION ALL SELECT * FROM later)
SELECT pool_name, extract_ts,
       min(start_time) AS min_request_start_time,
       max(start_time) AS max_start_time,
       date_sub('minute', min(start_time), max(start_time)) AS extract_window_minutes,
       date_sub('hour', min(start_time), max(start_time)) AS extract_window_hours,
       count(*) AS num_requests
FROM staged
GROUP BY extract_ts, pool_name"""


LISTINGS = ("workspace_info", "sql_pools", "spark_pools", "linked_services", "dataflows", "pipelines", "spark_jobs",
            "notebooks", "sql_scripts", "triggers", "libraries", "datasets")
# fields that the keep-lists leave of these listings; the others keep all
_KEPT = {"workspace_info": ("id", "name", "type"), "sql_pools": ("id", "name", "type", "sku")}


def _drifting() -> str:
    """Per listing and field: values, types and the greatest value as text."""
    value = {"id": "concat('/x/', CAST(p_partkey AS VARCHAR))", "name": "p_name", "type": "p_type",
             "sku": "concat('{\"brand\":\"', p_brand, '\",\"sizes\":[', CAST(p_size AS VARCHAR), ']}')",
             "size": "CASE WHEN ws = 1 THEN NULL ELSE CAST(p_size AS VARCHAR) END",
             "extra": "CASE WHEN ws = 2 THEN CAST(p_size > 25 AS VARCHAR) END"}
    kind = {"extra": "boolean"}
    one = [f"""SELECT '{d}' AS dataset, concat('ws_', CAST(ws AS VARCHAR)) AS workspace_name, '{f}' AS field,
  '{kind.get(f, "string")}' AS type, count(*) AS num_recs, count({v}) AS num_values, max({v}) AS greatest
FROM items WHERE d = {i} GROUP BY ws"""
           for i, d in enumerate(LISTINGS) for f, v in value.items() if d not in _KEPT or f in _KEPT[d]]
    return ("WITH items AS (SELECT *, p_partkey % 12 AS d, (p_partkey // 12) % 3 AS ws FROM part)\n" + "\nUNION ALL\n".join(one))


ORACLE.update({
    # the loop, token by token
    "linked_page_chain": r"""
WITH RECURSIVE items AS (
  SELECT concat('ws_', CAST(p_partkey % 3 AS VARCHAR)) AS ws, p_partkey // 1800 AS num,
         CAST(((p_partkey % 1800) // 60) + 1 AS INTEGER) AS n, concat('/items/', CAST(p_partkey AS VARCHAR)) AS id,
         p_name AS name, p_size AS size
  FROM part
),
named AS (SELECT DISTINCT ws, num, n, md5(concat(ws, '-', num, '-', n)) AS tok, md5(concat(ws, '-', num, '-', n + 1)) AS nxt,
                 md5(concat(ws, '-', num, '-', 3)) AS third FROM items),
pages AS (
  SELECT ws, num, n, CASE WHEN n = 1 THEN NULL ELSE tok END AS asked,
         CASE WHEN num % 5 = 1 AND n = 28 THEN third WHEN num % 5 = 2 AND n = 10 THEN 'gone'
              WHEN num % 2 = 0 AND n = 25 OR num % 3 = 0 AND n = 20 THEN NULL ELSE nxt END AS answer
  FROM named
),
walk(ws, num, n, answer, no, seen) AS (
  SELECT ws, num, n, answer, 1, [n] FROM pages WHERE asked IS NULL
  UNION ALL
  SELECT p.ws, p.num, p.n, p.answer, w.no + 1, list_append(w.seen, p.n)
  FROM walk w JOIN pages p ON p.ws = w.ws AND p.num = w.num AND p.asked = w.answer
  WHERE NOT list_contains(w.seen, p.n)
)
SELECT i.ws AS workspace_name, CAST(DATE '2024-01-01' + CAST(i.num AS INTEGER) AS TIMESTAMP) AS day,
       CAST(w.no AS INTEGER) AS page_no, i.id, i.name, i.size
FROM items i JOIN walk w ON i.ws = w.ws AND i.num = w.num AND i.n = w.n""",
    "drifting_listings": _drifting(),
    "union_by_collation": r"""
SELECT CAST(c_custkey AS VARCHAR) AS object, c_name AS label, n_name AS table_catalog, r_name AS collation_name
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "zoned_run_history": r"""
WITH runs AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'pipeline_runs' ELSE 'trigger_runs' END AS dataset,
         concat('ws_', CAST(o_custkey % 3 AS VARCHAR)) AS workspace_name, CAST(o_orderkey AS VARCHAR) AS run_id,
         o_orderstatus AS status, o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS last_updated,
         CASE o_custkey % 3 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Europe/Berlin' ELSE 'Asia/Kolkata' END AS zone
  FROM orders
),
d AS (
  SELECT *, CAST(timezone(zone, timezone('UTC', last_updated)) AS DATE) AS day,
         CAST(timezone(zone, timezone('UTC', TIMESTAMP '2001-04-21 02:30:00')) AS DATE) AS run_day
  FROM runs
)
SELECT dataset, workspace_name, CAST(day AS TIMESTAMP) AS last_upd, run_id, status, last_updated FROM d
WHERE day >= run_day - 59 AND day < run_day""",
    "stream_late_requests": _with(REQUESTS, CLASSIFIED) + f""",
first AS (SELECT * REPLACE (CASE WHEN request_id % 7 = 3 THEN NULL ELSE end_time END AS end_time)
          FROM classified WHERE day(start_time) < 15),
marks AS (SELECT pool_name AS k, max(end_time) AS mark FROM first GROUP BY pool_name),
later AS (SELECT c.* FROM classified c LEFT JOIN marks m ON c.pool_name = m.k
          WHERE c.end_time IS NOT NULL AND (m.mark IS NULL OR c.end_time > m.mark
                OR (c.pool_name, c.request_id) IN (SELECT (pool_name, request_id) FROM first WHERE end_time IS NULL)))
SELECT {CLASSIFIED_COLS} FROM first WHERE end_time IS NOT NULL
UNION ALL SELECT {CLASSIFIED_COLS} FROM later
UNION ALL SELECT {CLASSIFIED_COLS} FROM classified WHERE end_time IS NULL""",
    "dataset_preview": " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, CAST(sum(count(*)) OVER () AS BIGINT) AS row_count, min(md5(CAST({k} AS VARCHAR))) AS preview_hash, "
        f"CAST(arg_min({k}, md5(CAST({k} AS VARCHAR))) AS BIGINT) AS preview_key FROM {t} GROUP BY substr(md5(CAST({k} AS VARCHAR)), 4, 1)"
        for t, k in (("customer", "c_custkey"), ("documents", "doc_id"), ("events", "event_id"), ("orders", "o_orderkey"),
                     ("part", "p_partkey"), ("supplier", "s_suppkey"))),
    "allowed_pools": r"""
SELECT concat('/pools/', CAST(s_suppkey AS VARCHAR)) AS id, lower(replace(s_name, '#', '_')) AS name, 'Online' AS status
FROM supplier WHERE s_acctbal > 0
  AND lower(replace(s_name, '#', '_')) IN (SELECT printf('supplier_%09d', n) FROM range(3, 40, 3) t(n))""",
    "metric_span": r"""
WITH sel AS (SELECT concat('/ws/', CAST(o_custkey % 3 AS VARCHAR)) AS resource_id, 'IntegrationActivityRunsEnded' AS name,
                    o_orderdate AS ts, o_totalprice AS value FROM orders
             WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY)
SELECT resource_id, name, time_bucket(INTERVAL '1 hour', ts) AS "timestamp",
       round(sum(value), 4) / CAST(count(value) AS DOUBLE) AS average, CAST(count(value) AS DOUBLE) AS "count",
       round(max(value), 4) AS maximum, round(min(value), 4) AS minimum, round(sum(value), 4) AS total
FROM sel GROUP BY resource_id, name, time_bucket(INTERVAL '1 hour', ts)""",
    "node_query_stats": r"""
SELECT CAST(l_suppkey % 60 AS INTEGER) AS pdw_node_id, l_orderkey AS query_hash, CAST(l_linenumber AS INTEGER) AS execution_count,
       TIMESTAMP '2024-02-01 06:00:00' AS extract_ts FROM lineitem""",
    "serverless_activity": _with(REQUESTS) + r""",
r AS (SELECT concat('ws_', CAST(user_id % 3 AS VARCHAR)) AS workspace_name, q.* FROM requests q JOIN events e ON e.event_id = q.request_id),
first AS (SELECT * FROM r WHERE day(start_time) < 12),
m AS (SELECT workspace_name AS w, max(start_time) AS by_start, max(end_time) AS by_end FROM first GROUP BY workspace_name),
rows AS (
  SELECT 'session_requests' AS dataset, first.* FROM first UNION ALL SELECT 'requests_history', first.* FROM first
  UNION ALL SELECT 'session_requests', r.* FROM r LEFT JOIN m ON m.w = r.workspace_name WHERE by_start IS NULL OR start_time > by_start
  UNION ALL SELECT 'requests_history', r.* FROM r LEFT JOIN m ON m.w = r.workspace_name WHERE by_end IS NULL OR end_time > by_end
)
SELECT dataset, workspace_name, request_id, start_time, end_time, data_processed_mb
FROM rows JOIN (SELECT workspace_name, count(*) * 10 AS data_processed_mb FROM r GROUP BY workspace_name) USING (workspace_name)""",
})
