"""Drifting listings, local history windows, positional unions, previews and
requests that still run."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate.operators import analysis, filters, pages
from estate.plans import run
from estate.sources import dumps, jdbc, staging
from estate.streaming import incremental as stream

KEY = ["pool_name", "request_id"]


def _dump(spark, objects):
    """One page per object, in chains of one workspace each."""
    rows = [(ws, ds, None, no, f"t{no}", [json.dumps(o)]) for ws, ds, no, o in objects]
    df = spark.createDataFrame(rows, "workspace_name string, dataset string, day date, page_no int, continuation_token string, items array<string>")
    return df.withColumn("value", F.transform("items", lambda x: F.parse_json(x))).drop("items")


OBJECTS = [("a", "notebooks", 1, {"id": "1", "size": 3, "on": True, "props": {"x": [1]}, "Name": "n1", "none": None}),
           ("a", "notebooks", 2, {"id": "2", "size": 4.5, "on": False, "odd key's": 1}),
           ("b", "notebooks", 1, {"id": 7, "size": 10, "extra": "e", "mixed": 1}),
           ("b", "notebooks", 2, {"id": "8", "mixed": "one", "props": "text", "odd key's": 2}),
           ("a", "sql_pools", 1, {"id": "p", "Name": "pool", "status": "Online", "secret": 1, "sku": {"name": "DW100c"}})]


def test_drifting_listings_are_typed_over_all_workspaces(spark, root):
    d = _dump(spark, OBJECTS)
    fields = pages.listing_fields(d)
    assert fields["notebooks"] == {"Name": "string", "extra": "string", "id": "string", "mixed": "string", "none": "string",
                                   "odd key's": "bigint", "on": "boolean", "props": "string", "size": "double"}
    assert run.run_all(spark, root, run.ProfileInputs(listing_dumps=d)) == {"sql_pools": 1, "notebooks": 4}
    ws = os.path.join(root, run.WORKSPACE)
    got = staging.read(spark, ws, "notebooks")
    assert dict(got.dtypes)["size"] == "double" and dict(got.dtypes)["on"] == "boolean"
    assert sorted((r.workspace_name, r.id, r.size, r.on, r.extra, r.mixed, r.props, r.name, r["odd key's"]) for r in got.collect()) == [
        ("a", "1", 3.0, True, None, None, '{"x":[1]}', "n1", None), ("a", "2", 4.5, False, None, None, None, None, 1),
        ("b", "7", 10.0, None, "e", "1", None, None, None), ("b", "8", None, None, None, "one", "text", None, 2)]
    pools = staging.read(spark, ws, "sql_pools")
    assert "secret" not in pools.columns and pools.first().sku == '{"name":"DW100c"}'          # the keep-list holds
    assert run.run_all(spark, root, run.ProfileInputs(listing_dumps=d)) == {"sql_pools": None, "notebooks": None}


def test_drifting_dump_files(spark, root):
    path = os.path.join(root, "dump")
    dumps.write_dump(_dump(spark, OBJECTS), path)
    back = dumps.read_drifting_pages(spark, path)
    assert pages.drifts(back) and pages.listing_fields(back) == pages.listing_fields(_dump(spark, OBJECTS))
    assert pages.listing_fields(back.limit(0)) == {}


def test_local_windows_and_clock_change(spark):
    zones = spark.createDataFrame([("ny", "America/New_York"), ("in", "Asia/Kolkata"), ("none", None), ("de", "Europe/Berlin"), ("de", "Europe/Berlin")],
                                  "workspace_name string, time_zone string")
    w = filters.local_windows(zones, dt.datetime(2001, 4, 2, 3, 30), days=2)
    got = {r.workspace_name: (r.first_day, r.run_day) for r in w.collect()}
    assert got == {"ny": (dt.date(2001, 3, 30), dt.date(2001, 4, 1)), "in": (dt.date(2001, 3, 31), dt.date(2001, 4, 2)),
                   "none": (dt.date(2001, 3, 31), dt.date(2001, 4, 2)), "de": (dt.date(2001, 3, 31), dt.date(2001, 4, 2))}
    # New York changed its clocks on 1 April 2001: midnight is 05:00 UTC before and 04:00 after
    at = spark.createDataFrame([("ny", dt.datetime(2001, 4, 1, 4, 59)), ("ny", dt.datetime(2001, 4, 1, 5, 0)), ("ny", dt.datetime(2001, 4, 2, 3, 59)),
                                ("ny", dt.datetime(2001, 4, 2, 4, 0))], "workspace_name string, at timestamp_ntz").join(zones, "workspace_name")
    from estate.functions.timefns import local_date
    assert [r.d.day for r in at.select("at", local_date("at", F.col("time_zone")).alias("d")).orderBy("at").collect()] == [31, 1, 1, 2]
    days = spark.createDataFrame([(k, dt.date(2001, 3, d)) for k in ("ny", "in", "lost") for d in (29, 30, 31)], "workspace_name string, day date")
    assert sorted((r.workspace_name, r.day.day) for r in filters.in_local_window(days, w, "day").collect()) == [("in", 31), ("ny", 30), ("ny", 31)]


def test_union_by_position_takes_least_common_types(spark):
    a = spark.createDataFrame([(1, "x", 1.5, dt.date(2024, 1, 1))], "id int, name string, v float, at date")
    b = spark.createDataFrame([(2 ** 40, "7", 2, dt.datetime(2024, 1, 1, 5))], "object long, label string, w int, seen timestamp_ntz")
    c = spark.createDataFrame([(5, None, None, None)], "k short, l string, m double, n date")
    out = jdbc.union_by_position([a, b, c])
    assert out.columns == ["id", "name", "v", "at"]
    assert [t for _, t in out.dtypes] == ["bigint", "string", "double", "timestamp_ntz"]
    assert sorted(out.collect(), key=str) == sorted(
        [(1, "x", 1.5, dt.datetime(2024, 1, 1)), (2 ** 40, "7", 2.0, dt.datetime(2024, 1, 1, 5)), (5, None, None, None)], key=str)
    text = jdbc.union_by_position([a.select("id"), a.select("name")])
    assert text.dtypes == [("id", "string")] and sorted(r.id for r in text.collect()) == ["1", "x"]
    with pytest.raises(ValueError):
        jdbc.union_by_position([a, a.drop("v")])


def test_union_by_collation_is_a_balanced_tree_per_group(spark):
    view = lambda name: spark.range(1).select(F.lit(len(name)).alias(f"c_{name}"))
    listed = [(f"db{'x' * i}", ["A", None, "B"][i % 3]) for i in range(24)]
    out = jdbc.union_by_collation(view, listed)
    assert sorted((r.table_catalog, r.collation_name) for r in out.collect()) == sorted(listed)
    assert jdbc.union_by_collation(view, []) is None


def test_preview_is_one_scan_without_sorting(spark):
    df = spark.range(1000).select("id", F.concat(F.lit("v"), "id").alias("v"))
    out = analysis.dataset_preview({"big": df, "none": df.limit(0), "few": df.filter("id < 3")}, rows=8)
    rows = [r for r in out.collect() if r.dataset == "big"]
    assert {r.row_count for r in rows} == {1000} and len(rows) == 8 and abs(rows[0].distinct_rows - 1000) < 250
    held = [json.loads(r.preview) for r in rows]
    assert all(h["v"] == f"v{h['id']}" for h in held)
    other = [r for r in analysis.dataset_preview({"big": df.repartition(7)}, rows=8).collect()]
    assert sorted(r.preview for r in other) == sorted(r.preview for r in rows)                # however the rows lie
    assert [(r.row_count, r.preview) for r in out.collect() if r.dataset == "none"] == [(0, None)]
    assert len([r for r in out.collect() if r.dataset == "few"]) <= 3
    assert "SortAggregate" not in analysis.dataset_preview({"big": df})._jdf.queryExecution().executedPlan().toString()


def _requests(spark, rows):
    schema = T.StructType([T.StructField("pool_name", T.StringType()), T.StructField("request_id", T.LongType()),
                           T.StructField("start_time", T.TimestampNTZType()), T.StructField("end_time", T.TimestampNTZType())])
    at = lambda m: None if m is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    return spark.createDataFrame([(p, i, at(s), at(e)) for p, i, s, e in rows], schema)


def _all(spark, root):
    return sorted(((r.pool_name, r.request_id, None if r.end_time is None else (r.end_time - dt.datetime(2024, 1, 1)).seconds // 60)
                   for r in stream.current(spark, root, "r").collect()), key=str)


def test_running_requests_are_replaced_when_they_finish(spark, root):
    source, ckpt = os.path.join(root, "source"), os.path.join(root, "ckpt")
    first = _requests(spark, [("p", 1, 0, 10), ("p", 2, 0, None), ("p", 3, 1, None), (None, 4, 0, None)])
    second = _requests(spark, [("p", 2, 0, 5), ("p", 3, 1, None), ("p", 5, 3, 20), ("p", 6, 4, 6), (None, 4, 0, 2), ("p", 7, 30, None)])
    go = lambda: stream.stream_new(spark, source, first.schema, root, "r", "end_time", ckpt, request_key=KEY)
    first.write.mode("append").parquet(source)
    assert go() == [1]
    assert _all(spark, root) == sorted([("p", 1, 10), ("p", 2, None), ("p", 3, None), (None, 4, None)], key=str)
    second.write.mode("append").parquet(source)
    assert go() == [3]                       # 2 and 4 finished below or without a mark, 5 above it; 6 is below and was never running
    want = sorted([("p", 1, 10), ("p", 2, 5), ("p", 3, None), ("p", 5, 20), ("p", 7, None), (None, 4, 2)], key=str)
    assert _all(spark, root) == want
    assert go() == [] and _all(spark, root) == want                                           # a restart changes nothing
    stream.stage_with_running(spark, second, root, "r", "end_time", ["pool_name"], KEY)        # nor does the same snapshot again
    assert _all(spark, root) == want
    late = _requests(spark, [("p", 8, 600, 700)])
    stream.stage_with_running(spark, late, root, "r", "end_time", ["pool_name"], KEY, forget="2 hours")
    assert sorted(r.request_id for r in staging.read(spark, root, "r_running").collect()) == [3, 7]      # the mark was at 20
    stream.stage_with_running(spark, late, root, "r", "end_time", ["pool_name"], KEY, forget="2 hours")
    assert staging.read(spark, root, "r_running").collect() == []                             # given up, but kept as rows
    assert _all(spark, root) == sorted([*want, ("p", 8, 700)], key=str)
