"""Declared schemas of the dumped API responses and the staged datasets we
test.  Reads use these instead of inference, so types never depend on the
data that happened to arrive."""

from __future__ import annotations

from pyspark.sql import types as T

# API responses carry zoned times ("...Z", "+02:00"): read as instants
# (TIMESTAMP); the flatten operators stage them as UTC wall clock.
METRIC_POINT = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("average", T.DoubleType()),
    T.StructField("count", T.DoubleType()),
    T.StructField("maximum", T.DoubleType()),
    T.StructField("minimum", T.DoubleType()),
    T.StructField("total", T.DoubleType()),
])

METRIC_RESPONSE = T.StructType([
    T.StructField("workspace_name", T.StringType()),
    T.StructField("pool_name", T.StringType()),
    T.StructField("resource_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timeseries", T.ArrayType(T.StructType([
        T.StructField("data", T.ArrayType(METRIC_POINT)),
    ]))),
])


def page_dump(item: T.DataType) -> T.StructType:
    """One dumped listing page whose objects have schema ``item``."""
    return T.StructType([
        T.StructField("workspace_name", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("continuation_token", T.StringType()),
        T.StructField("value", T.ArrayType(item)),
    ])


def drifting_dump() -> T.StructType:
    """One dumped listing page whose objects have no fixed shape."""
    return page_dump(T.VariantType())


SQL_POOL = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("sku", T.StructType([T.StructField("name", T.StringType()),
                                       T.StructField("capacity", T.IntegerType())])),
    T.StructField("provisioning_state", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("creation_date", T.TimestampType()),
])

PIPELINE_RUN = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_updated", T.TimestampType()),
])


WORKSPACE_INFO = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("workspace_uid", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("provisioning_state", T.StringType()),
    T.StructField("default_data_lake_storage", T.StringType()),        # JSON text
    T.StructField("workspace_repository_configuration", T.StringType()),  # JSON text
    T.StructField("purview_configuration", T.StringType()),            # JSON text
    T.StructField("extra_properties", T.StringType()),                 # JSON text
])
