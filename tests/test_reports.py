"""A1, A2 / F12, A5, J1 on small hand cases."""

import datetime as dt

from estate.operators import analysis


def test_storage_mb(spark):
    df = spark.createDataFrame([(1, 127, 1), (1, 130, 1)],
                               "pdw_node_id int, reserved_page_count bigint, used_page_count bigint")
    r = analysis.storage_by_node(df).first()
    assert (r.node_id, r.ReservedSpaceMB, r.UsedSpaceMB) == (1, 2, 0)


def test_whole_units(spark):
    t = lambda h, m, s: dt.datetime(2024, 1, 1, h, m, s)
    rows = [(1, "p", t(0, 0, 59), dt.datetime(2024, 1, 1)),
            (2, "p", t(0, 1, 0), dt.datetime(2024, 1, 1)),
            (3, "q", t(0, 0, 30), dt.datetime(2024, 1, 1)),
            (4, "q", t(1, 59, 59), dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "request_id int, pool_name string, start_time timestamp_ntz, "
                                     "extract_ts timestamp_ntz")
    got = {r.pool_name: (r.extract_window_minutes, r.extract_window_hours, r.num_requests)
           for r in analysis.request_window(df).collect()}
    assert got == {"p": (0, 0, 2), "q": (119, 1, 2)}


def test_latest_window_is_newest_extract_first_pool(spark):
    rows = [(1, "b", dt.datetime(2024, 1, 2, 1), dt.datetime(2024, 1, 2)),
            (2, "a", dt.datetime(2024, 1, 2, 2), dt.datetime(2024, 1, 2)),
            (3, "a", dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "request_id int, pool_name string, start_time timestamp_ntz, "
                                     "extract_ts timestamp_ntz")
    r = analysis.latest_request_window(df).collect()
    assert len(r) == 1 and (r[0].pool_name, r[0].extract_ts) == ("a", dt.datetime(2024, 1, 2))


def test_databases_by_collation_null_group(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("c", "X")], "name string, collation_name string")
    got = {r.name: (r.collation_name, r.databases_in_collation)
           for r in analysis.databases_by_collation(df).collect()}
    assert got == {"a": (None, 2), "b": (None, 2), "c": ("X", 1)}


def test_service_tiers(spark):
    obj = spark.createDataFrame([(1, "DW", "DW100c"), (2, "DW", "DW200c"), (9, "DW", "x")],
                                "database_id long, edition string, service_objective string")
    dbs = spark.createDataFrame([(1, "a"), (2, "b")], "database_id long, name string")
    got = sorted(tuple(r) for r in analysis.service_tiers(obj, dbs).collect())
    assert got == [("a", "DW", "DW100c"), ("b", "DW", "DW200c")]


def test_whole_units_ignore_session_zone_and_dst(spark):
    """Wall-clock differences of timestamps without time zone do not change
    with the session zone, even across (or inside) a DST gap."""
    rows = [(1, "p", dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10)),
            (2, "p", dt.datetime(2024, 3, 10, 3, 30, 0, 1), dt.datetime(2024, 3, 10))]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame(rows, "request_id int, pool_name string, "
                                             "start_time timestamp_ntz, extract_ts timestamp_ntz")
            r = analysis.request_window(df).first()
            assert (r.extract_window_minutes, r.extract_window_hours) == (60, 1), tz
            assert r.extract_ts == dt.datetime(2024, 3, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_merged_partial_windows_equal_one_pass(spark):
    from pyspark.sql import functions as F

    from estate.plans.queries import staged_requests
    from conftest import SF_SMALL
    reqs = staged_requests(spark, SF_SMALL)
    a, b = reqs.filter(F.col("request_id") % 3 == 0), reqs.filter(F.col("request_id") % 3 != 0)
    parts = analysis.request_window_parts(a).unionByName(analysis.request_window_parts(b))
    merged = sorted(tuple(r) for r in analysis.merge_request_windows(parts).collect())
    direct = sorted(tuple(r) for r in analysis.request_window(reqs).collect())
    assert merged == direct and len(direct) > 0
