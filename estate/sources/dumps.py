"""Dumped API responses as DataFrames (input side of S23-S43).

A listing or run query dumps one JSON line per page; a metrics query dumps
one JSON line per metric response.  They are read with declared schemas (no
inference pass over the files, stable types), split by file like any other
JSON source, and handed to :mod:`estate.operators.pages` /
:mod:`estate.operators.metrics`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from estate import schemas
from estate.sources.staging import TEXT_TIME_OPTIONS


def read_pages(spark: SparkSession, path: str, item: T.StructType) -> DataFrame:
    """Page dumps (JSON lines) whose objects have schema ``item``."""
    return (spark.read.schema(schemas.page_dump(item))
            .option("mode", "FAILFAST").json(path))


def read_drifting_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page dumps (JSON lines) whose objects are read as VARIANT values: listings
    whose fields differ between workspaces (:func:`estate.operators.pages.listing_fields`)."""
    return (spark.read.schema(schemas.drifting_dump())
            .option("mode", "FAILFAST").json(path))


def read_metric_responses(spark: SparkSession, path: str) -> DataFrame:
    """Metric-response dumps (JSON lines)."""
    return (spark.read.schema(schemas.METRIC_RESPONSE)
            .option("mode", "FAILFAST").json(path))


def write_dump(df: DataFrame, path: str) -> None:
    """Store pages or responses as JSON lines (the dump format)."""
    df.write.mode("append").options(**TEXT_TIME_OPTIONS).json(path)
