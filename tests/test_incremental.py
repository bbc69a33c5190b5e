"""Incremental staging equals a full load."""

import datetime as dt

from pyspark.sql import functions as F

from estate.operators import incremental
from estate.sources import activity, staging, tables
from estate.streaming.incremental import stage_new_rows, stream_new

from conftest import SF_SMALL


def _raw(spark):
    return tables.requests(spark, SF_SMALL).filter(F.col("end_time").isNotNull())


def test_slices_equal_full_load(spark, root):
    raw = _raw(spark)
    cuts = [dt.datetime(2024, 1, d) for d in (5, 12, 20)]
    for cut in cuts + [None]:
        part = raw if cut is None else raw.filter(F.col("end_time") <= F.lit(cut).cast("timestamp_ntz"))
        stage_new_rows(spark, part, root, "session_requests", "end_time")
    got = staging.read(spark, root, "session_requests")
    assert got.count() == raw.count()
    assert got.select("request_id").distinct().count() == raw.count()


def test_null_keys_and_zoned_marks(spark):
    """A null key has its own mark, and TIMESTAMP marks mean their instant."""
    rows = [(1, None, dt.datetime(2024, 1, 1, 9)), (2, None, dt.datetime(2024, 1, 1, 11)),
            (3, "p", dt.datetime(2024, 1, 1, 9)), (4, "q", dt.datetime(2024, 1, 1, 9))]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(rows, f"id long, pool_name string, end_time {kind}")
        marks = spark.createDataFrame([(None, dt.datetime(2024, 1, 1, 10)), ("p", dt.datetime(2024, 1, 1, 9)), ("r", None)],
                                      f"pool_name string, {incremental.MARK} {kind}")
        for more in (0, 400):          # whatever the number of marks
            extra = spark.range(more).selectExpr("concat('x', id) AS pool_name", f"CAST(NULL AS {kind}) AS {incremental.MARK}")
            got = incremental.newer_than(df, "end_time", marks.unionByName(extra))
            assert sorted(r.id for r in got.collect()) == [2, 4]


def test_lateness_leaves_staged_versions_out(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 10, m)
    schema = "pool_name string, request_id long, end_time timestamp_ntz"
    staged = spark.createDataFrame([("p", 1, t(0)), ("p", 2, None), ("q", 1, t(5)), ("p", 9, t(20))], schema)
    raw = spark.createDataFrame([("p", 1, t(0)), ("p", 2, t(18)), ("q", 1, t(5)), ("p", 9, t(20)), ("p", 10, t(21)), ("p", 11, t(16))], schema)
    marks = incremental.high_water(staged, "end_time")
    new = incremental.newer_than(raw, "end_time", marks, lateness="10 minutes")
    new = incremental.not_staged(new, staged, "end_time", marks, ["pool_name", "request_id"], lateness="10 minutes")
    assert sorted((r.pool_name, r.request_id) for r in new.collect()) == [("p", 2), ("p", 10), ("p", 11)]


def test_many_micro_batches_stage_the_whole_snapshot(spark, root):
    raw = _raw(spark)
    source, ckpt = f"{root}/source", f"{root}/_ckpt"
    half = raw.filter(F.dayofmonth("start_time") < 12)
    for snapshot in (half, raw):
        snapshot.repartition(5).write.mode("append").parquet(source)
        stream_new(spark, source, raw.schema, root, "reqs", "end_time", ckpt, max_files_per_trigger=1, report="parts")
    staged = staging.read(spark, root, "reqs")
    assert staged.count() == half.count() + raw.join(
        half.groupBy("pool_name").agg(F.max("end_time").alias("m")), "pool_name", "left").filter("m IS NULL OR end_time > m").count()
    from estate.operators import analysis
    kept = analysis.merge_request_windows(staging.read(spark, root, "parts"))
    full = analysis.request_window(staged)
    assert kept.exceptAll(full).count() == 0 and full.exceptAll(kept).count() == 0


def test_global_mark(spark):
    raw = _raw(spark)
    earlier = raw.filter(F.dayofmonth("start_time") < 10)
    marks = incremental.high_water(earlier, "end_time", scope="global")
    top = earlier.agg(F.max("end_time")).first()[0]
    got = incremental.newer_than(raw, "end_time", marks)
    assert got.count() == raw.filter(F.col("end_time") > F.lit(top).cast("timestamp_ntz")).count()


def test_lateness_and_keep_newest(spark):
    rows = [(1, "p", dt.datetime(2024, 1, 1, 10, 0), None),
            (1, "p", dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 5)),
            (2, "p", dt.datetime(2024, 1, 1, 9, 0), dt.datetime(2024, 1, 1, 9, 58))]
    df = spark.createDataFrame(rows, "request_id long, pool_name string, start_time timestamp_ntz, "
                                     "end_time timestamp_ntz")
    marks = spark.createDataFrame([("p", dt.datetime(2024, 1, 1, 10, 0))],
                                  f"pool_name string, {incremental.MARK} timestamp_ntz")
    late = incremental.newer_than(df, "end_time", marks, lateness="5 minutes")
    assert sorted(r.request_id for r in late.collect()) == [1, 2]
    newest = incremental.keep_newest(df, ["request_id"], "end_time").collect()
    got = {r.request_id: r.end_time for r in newest}
    assert got == {1: dt.datetime(2024, 1, 1, 10, 5), 2: dt.datetime(2024, 1, 1, 9, 58)}


def test_stream_second_start_adds_nothing(spark, root):
    raw = tables.requests(spark, SF_SMALL)
    source, ckpt = f"{root}/source", f"{root}/_ckpt"
    transform = lambda b, m: activity.dedicated_requests(b, marks=m)
    raw.write.parquet(source)
    first = stream_new(spark, source, raw.schema, root, "reqs", "end_time", ckpt, transform=transform)
    again = stream_new(spark, source, raw.schema, root, "reqs", "end_time", ckpt, transform=transform)
    assert sum(first) == activity.dedicated_requests(raw).count()
    assert again == []


def test_stream_with_processing_time_trigger(spark, root):
    from estate.streaming.incremental import start_stream
    raw = tables.requests(spark, SF_SMALL)
    source, ckpt = f"{root}/src", f"{root}/_ck"
    raw.write.parquet(source)
    rows = []
    q = start_stream(spark, source, raw.schema, root, "reqs", "end_time", ckpt,
                     transform=lambda b, m: activity.dedicated_requests(b, marks=m),
                     every="1 second", on_batch=lambda bid, n: rows.append(n))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sum(rows) == activity.dedicated_requests(raw).count()


def test_replayed_batch_appends_nothing(spark, root):
    raw = _raw(spark)
    first = stage_new_rows(spark, raw, root, "session_requests", "end_time")
    replay = stage_new_rows(spark, raw, root, "session_requests", "end_time")
    assert first == raw.count() and replay == 0


def test_serverless_activity_filters(spark):
    """Stamp only, or the strict mark on their column."""
    rows = [(1, "built-in", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)),
            (2, "built-in", dt.datetime(2024, 1, 2, 10), dt.datetime(2024, 1, 2, 11))]
    df = spark.createDataFrame(rows, "id long, pool_name string, start_time timestamp_ntz, "
                                     "end_time timestamp_ntz")
    marks = incremental.high_water(df.filter("id = 1"), "end_time")
    assert [r.id for r in activity.requests_history(df, marks).collect()] == [2]
    marks = incremental.high_water(df.filter("id = 1"), "start_time")
    assert [r.id for r in activity.serverless_requests(df, marks).collect()] == [2]
    assert activity.data_processed(df).count() == 2
    stamped = activity.dedicated_query_stats(df, dt.datetime(2024, 2, 1))
    assert {r.extract_ts for r in stamped.collect()} == {dt.datetime(2024, 2, 1)}
