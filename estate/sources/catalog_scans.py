"""Catalog scans of SQL pools.

Each function reads one catalog relation through :mod:`estate.sources.jdbc`
and applies the extract's projection, filter or redaction as DataFrame
operations (pushed to the source where possible).  A serverless pool holds
many databases; its scans are one per database, unioned.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from estate.functions.sqltext import redact
from estate.operators import filters
from estate.sources.jdbc import PoolConnection, quoted, run_query, union_databases

# fixed values: columns of the database listing
DATABASE_COLUMNS = ("name", "database_id", "create_date", "state", "state_desc", "collation_name")


def databases(spark: SparkSession, conn: PoolConnection) -> DataFrame:
    """S4 + P2: the database listing without 'master'."""
    df = run_query(spark, conn, "sys.databases").select(*DATABASE_COLUMNS)
    return filters.not_master(df)


def _catalog(spark, conn, view: str, dbs: Iterable[str] | None) -> DataFrame | None:
    if dbs is None:   # dedicated pool: one database per connection
        return run_query(spark, conn, f"information_schema.{view}")
    return union_databases(lambda db: run_query(spark, conn, f"{quoted(db)}.information_schema.{view}"),
                           dbs, label=None)


def tables(spark: SparkSession, conn: PoolConnection, dbs: Iterable[str] | None = None):
    """S5 / S14."""
    return _catalog(spark, conn, "tables", dbs)


def columns(spark: SparkSession, conn: PoolConnection, dbs: Iterable[str] | None = None):
    """S6 / S15."""
    return _catalog(spark, conn, "columns", dbs)


def views(spark: SparkSession, conn: PoolConnection, dbs: Iterable[str] | None = None,
          redact_text: bool = False):
    """S7 / S16 (+F10 on view_definition)."""
    df = _catalog(spark, conn, "views", dbs)
    return redact(df, "view_definition") if (redact_text and df is not None) else df


def routines(spark: SparkSession, conn: PoolConnection, dbs: Iterable[str] | None = None,
             redact_text: bool = False):
    """S8 / S17 (+F10 on routine_definition)."""
    df = _catalog(spark, conn, "routines", dbs)
    return redact(df, "routine_definition") if (redact_text and df is not None) else df


def storage_partition_stats(spark: SparkSession, conn: PoolConnection) -> DataFrame:
    """Input of A1 (:func:`estate.operators.analysis.storage_by_node`)."""
    return run_query(spark, conn, "sys.dm_pdw_nodes_db_partition_stats").select(
        "pdw_node_id", "reserved_page_count", "used_page_count")


def service_objectives(spark: SparkSession, conn: PoolConnection) -> DataFrame:
    """Input of J1 (:func:`estate.operators.analysis.service_tiers`)."""
    return run_query(spark, conn, "sys.database_service_objectives").select(
        "database_id", "edition", "service_objective")


def databases_in_scope(dbs: DataFrame, include: Iterable[str] = (),
                       exclude: Iterable[str] = filters.DEFAULT_EXCLUDED_DATABASES) -> DataFrame:
    """Databases to profile."""
    return filters.in_scope(dbs, "name", include, exclude)


def database_names(dbs: DataFrame) -> list[str]:
    """Names of the databases to scan over their own connections, in order (the
    databases of one server; each becomes one JDBC load of the driver's plan)."""
    return sorted(r.name for r in dbs.select("name").distinct().collect())


__all__ = ["databases", "tables", "columns", "views", "routines", "storage_partition_stats",
           "service_objectives", "databases_in_scope", "database_names"]
