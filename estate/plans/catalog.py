"""Analyzer schema: one relation per staged dataset (K5).

``register_views`` creates the schema if needed and, for each category folder
present under the workspace root, one ``<category>_<dataset>`` relation per
dataset folder: a view over the staged folder with the recorded column types,
so queries on it see what is in the folder when they run.  Partition columns are
Spark's own, so filters on them prune folders (``PartitionFilters``); datasets
written in batches show their committed batches.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from estate.operators.analysis import dataset_profile
from estate.sources import batches, staging

# fixed values: category name -> folder of the staged group
CATEGORIES = {
    "workspace": "workspace",
    "metrics": "monitoring_metrics",
    "serverless": "sqlpools-serverless",
    "dedicated": "sqlpools-dedicated",
}


def _list_dirs(spark: SparkSession, path: str) -> list[str]:
    h = staging._fs(spark, path)
    if h is None or not h[0].exists(h[1]):
        return []
    fs, jpath = h
    return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(jpath) if st.isDirectory())
                  if not n.startswith(("_", ".")) and not n.endswith(batches.MARKS))


def _file_format(spark: SparkSession, path: str) -> str | None:
    """Format of a staged folder's files by their suffix; ``None`` without files."""
    h = staging._fs(spark, path)
    if h is None:
        return None
    files = h[0].listFiles(h[1], True)
    while files.hasNext():
        found = files.next().getPath()
        name = found.getName()
        if not name.startswith(("_", ".")):
            if ".json" in name:
                return "json"
            if ".parquet" in name:
                return "parquet"
    return None


def _view_sql(spark: SparkSession, group_root: str, dataset: str) -> str | None:
    df = staging.read(spark, group_root, dataset)
    if df is None:
        return None
    path = staging.dataset_path(group_root, dataset)
    fmt = _file_format(spark, path)
    log = os.path.join(group_root, batches.COMMITS)
    batched = staging.BATCH in staging._partition_columns(spark, path)
    if fmt is None or batched and not staging._exists(spark, log):      # nothing staged yet: the typed empty relation
        cols = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema.fields)
        return f"SELECT {cols} WHERE false"
    cols = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema.fields)
    live = (f" WHERE {staging.BATCH} IN (SELECT batch_id FROM parquet.`{log}` WHERE dataset = '{dataset}'"
            " GROUP BY batch_id HAVING NOT max(action = 'drop'))")
    return f"SELECT {cols} FROM {fmt}.`{path}`" + (live if batched else "")


def register_views(spark: SparkSession, workspace_root: str, schema: str,
                   categories: dict[str, str] | None = None) -> list[str]:
    """K5: create ``schema`` and a view per staged dataset; absent categories
    are skipped.  Returns the qualified view names.

    A view reads its folder anew in each query, so pools staged later appear by
    themselves; it is replaced in one step.  Its column types are those recorded
    with the dataset (folder values stay text, see ``staging._mark_text_folders``),
    and it works over Parquet and JSON folders alike."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    made = []
    for category, folder in (categories or CATEGORIES).items():
        group_root = os.path.join(workspace_root, folder)
        for dataset in _list_dirs(spark, group_root):
            sql = _view_sql(spark, group_root, dataset)
            if sql is not None:
                name = f"{category}_{dataset}".replace("-", "_")
                spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS {sql}")
                made.append(f"{schema}.{name}")
    return made


def profile_staged(spark: SparkSession, workspace_root: str,
                   categories: dict[str, str] | None = None) -> DataFrame | None:
    """K6 over staged data: the row count of every staged dataset, named
    ``<category>_<dataset>`` like the analyzer relations (counts come from
    Parquet footers where no filter applies).  ``None`` when nothing is
    staged."""
    frames = {}
    for category, folder in (categories or CATEGORIES).items():
        group_root = os.path.join(workspace_root, folder)
        for dataset in _list_dirs(spark, group_root):
            df = staging.read(spark, group_root, dataset)
            if df is not None:
                frames[f"{category}_{dataset}".replace("-", "_")] = df
    return dataset_profile(frames) if frames else None
