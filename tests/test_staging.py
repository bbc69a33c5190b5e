"""Round trips, partition types, dynamic overwrite, steps."""

import datetime as dt

from pyspark.sql import functions as F

from estate.plans import catalog
from estate.sources import staging


def _rows(spark):
    return spark.createDataFrame(
        [(1, "007", dt.datetime(2024, 1, 1, 1)), (2, "007", dt.datetime(2024, 1, 1, 2)),
         (3, "pool_b", dt.datetime(2024, 1, 2, 3))],
        "request_id long, pool_name string, start_time timestamp_ntz")


def test_roundtrip_keeps_types_and_rows(spark, root):
    df = _rows(spark)
    assert staging.write(df, root, "session_requests") == 3
    back = staging.read(spark, root, "session_requests")
    assert dict(back.dtypes) == {"request_id": "bigint", "pool_name": "string",
                                 "start_time": "timestamp_ntz"}
    assert sorted(back.collect()) == sorted(df.select(*back.columns).collect())
    assert {r.pool_name for r in back.collect()} == {"007", "pool_b"}


def test_missing_dataset_reads_none(spark, root):
    assert staging.read(spark, root, "nothing_here") is None


def test_overwrite_replaces_one_pool_only(spark, root):
    staging.write(_rows(spark), root, "tables")
    new = spark.createDataFrame([(9, "007", dt.datetime(2024, 2, 1))],
                                "request_id long, pool_name string, start_time timestamp_ntz")
    staging.write(new, root, "tables", mode="overwrite")
    got = sorted((r.pool_name, r.request_id) for r in staging.read(spark, root, "tables").collect())
    assert got == [("007", 9), ("pool_b", 3)]


def test_step_runs_once(spark, root):
    calls = []

    def fn():
        calls.append(1)
        return _rows(spark)
    assert staging.write_step(spark, root, "sessions", fn) == 3
    assert staging.write_step(spark, root, "sessions", fn) is None
    assert len(calls) == 1
    st = staging.steps(spark, root).collect()
    assert [(r.dataset, r.partition, r.num_recs, r.status) for r in st] == [("sessions", None, 3, "done")]
    assert staging.read(spark, root, "sessions").count() == 3


def test_partitioned_steps_pending(spark, root):
    df = _rows(spark).withColumn("last_upd", F.to_date("start_time"))
    day1 = df.filter(F.col("last_upd") == dt.date(2024, 1, 1))
    staging.write_step(spark, root, "pipeline_runs", lambda: day1,
                       partition="last_upd=2024-01-01", partition_by=("last_upd",))
    pend = staging.pending_partitions(spark, root, "pipeline_runs",
                                      ["last_upd=2024-01-01", "last_upd=2024-01-02"])
    assert pend == ["last_upd=2024-01-02"]


def test_json_format(spark, root):
    staging.write(_rows(spark), root, "json_ds", fmt="json")
    back = staging.read(spark, root, "json_ds", fmt="json")
    assert back.count() == 3 and dict(back.dtypes)["pool_name"] == "string"


def test_analyzer_relations(spark, root):
    group = f"{root}/sqlpools-dedicated"
    staging.write(_rows(spark), group, "session_requests")
    made = catalog.register_views(spark, root, "estate_test_schema")
    assert made == ["estate_test_schema.dedicated_session_requests"]
    t = spark.table("estate_test_schema.dedicated_session_requests")
    assert t.count() == 3 and dict(t.dtypes)["pool_name"] == "string"
    assert t.filter(F.col("pool_name") == "007").count() == 2


def test_partition_steps_in_one_job(spark, root):
    df = _rows(spark).withColumn("last_upd", F.to_date("start_time"))
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    first = staging.write_partition_steps(spark, root, "runs", df.filter(F.col("request_id") < 3),
                                          "last_upd", days[:1])
    assert first == {"last_upd=2024-01-01": 2}
    second = staging.write_partition_steps(spark, root, "runs", df, "last_upd", days)
    assert second == {"last_upd=2024-01-02": 1, "last_upd=2024-01-03": 0}
    assert staging.write_partition_steps(spark, root, "runs", df, "last_upd", days) == {}
    assert staging.read(spark, root, "runs").count() == 3


def test_empty_write_reads_typed_empty(spark, root):
    empty = spark.createDataFrame([], "a int, pool_name string")
    assert staging.write(empty, root, "nothing") == 0
    back = staging.read(spark, root, "nothing")
    assert back.count() == 0 and dict(back.dtypes) == {"a": "int", "pool_name": "string"}


def test_json_lines(spark):
    import json
    df = spark.createDataFrame([(1, "a", None)], "id int, name string, note string")
    line = staging.to_json_lines(df).first().value
    assert json.loads(line) == {"id": 1, "name": "a"}


def test_rebalanced_write_keeps_few_files_per_pool(spark, root):
    import os
    df = spark.range(4000).select((F.col("id") % 3).cast("string").alias("pool_name"),
                                  F.col("id")).repartition(16)
    staging.write(df, root, "many")
    staging.write(df, root, "raw", rebalance=False)

    def files(ds):
        base = os.path.join(root, ds)
        return max(len([f for f in os.listdir(os.path.join(base, d)) if f.endswith(".parquet")])
                   for d in os.listdir(base) if d.startswith("pool_name="))
    assert files("many") <= 2 < files("raw")
    assert staging.read(spark, root, "many").count() == 4000


def test_profile_staged(spark, root):
    staging.write(_rows(spark), f"{root}/sqlpools-dedicated", "session_requests")
    staging.write(_rows(spark).limit(1), f"{root}/sqlpools-serverless", "sessions")
    got = {r.dataset: r.row_count for r in catalog.profile_staged(spark, root).collect()}
    assert got == {"dedicated_session_requests": 3, "serverless_sessions": 1}
    assert catalog.profile_staged(spark, f"{root}/nothing") is None


def test_json_keeps_microseconds(spark, root):
    t = dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    df = spark.createDataFrame([(1, "p", t)], "id int, pool_name string, t timestamp_ntz")
    staging.write(df, root, "j", fmt="json")
    assert staging.read(spark, root, "j", fmt="json").first().t == t


def test_json_keeps_binary_and_decimal_types(spark, root):
    from decimal import Decimal
    df = spark.createDataFrame([(bytearray(b"\x01\x02\xff"), Decimal("12.345"), "p")],
                               "sql_handle binary, amount decimal(10,3), pool_name string")
    staging.write(df, root, "typed", fmt="json")
    back = staging.read(spark, root, "typed", fmt="json")
    assert dict(back.dtypes) == {"sql_handle": "binary", "amount": "decimal(10,3)",
                                 "pool_name": "string"}
    r = back.first()
    assert (bytes(r.sql_handle), r.amount) == (b"\x01\x02\xff", Decimal("12.345"))


def test_appends_with_different_columns_read_as_union(spark, root):
    a = spark.createDataFrame([(1, "x", "p")], "id int, old_col string, pool_name string")
    b = spark.createDataFrame([(2, 2.5, "p")], "id int, new_col double, pool_name string")
    staging.write(a, root, "evolving")
    staging.write(b, root, "evolving")
    back = staging.read(spark, root, "evolving")
    assert set(back.columns) == {"id", "old_col", "new_col", "pool_name"}
    got = sorted((r.id, r.old_col, r.new_col) for r in back.collect())
    assert got == [(1, "x", None), (2, None, 2.5)]


def test_compact_steps(spark, root):
    for i in range(5):
        staging.write_step(spark, root, f"ds{i}", lambda: _rows(spark), partition_by=())
    assert staging._data_files(spark, f"{root}/_steps") == 5
    assert staging.compact_steps(spark, root, max_files=3)
    assert staging._data_files(spark, f"{root}/_steps") == 1
    assert staging.steps(spark, root).count() == 5
    assert staging.write_step(spark, root, "ds0", lambda: _rows(spark), partition_by=()) is None


def test_compact_rewrites_only_heavy_partitions(spark, root):
    import os
    base = spark.range(40).select(F.when(F.col("id") < 30, "hot").otherwise("cold").alias("pool_name"),
                                  F.col("id"))
    for i in range(6):     # six appends: six files in each pool folder
        staging.write(base.filter(F.col("id") % 6 == i), root, "acts")
    cold_before = sorted(os.listdir(f"{root}/acts/pool_name=cold"))
    assert staging.compact(spark, root, "acts", max_files=3) == 2
    hot = [f for f in os.listdir(f"{root}/acts/pool_name=hot") if f.endswith(".parquet")]
    assert len(hot) == 1
    assert staging.read(spark, root, "acts").count() == 40
    assert staging.compact(spark, root, "acts", max_files=3) == 0
    # a threshold above the cold pool's count leaves it untouched
    staging.write(base.filter("pool_name = 'hot'"), root, "acts2")
    staging.write(base.filter("pool_name = 'cold'"), root, "acts2")
    for _ in range(3):
        staging.write(base.filter("pool_name = 'hot'"), root, "acts2")
    cold2 = sorted(os.listdir(f"{root}/acts2/pool_name=cold"))
    assert staging.compact(spark, root, "acts2", max_files=2) == 1
    assert sorted(os.listdir(f"{root}/acts2/pool_name=cold")) == cold2
    assert cold_before  # cold folder existed in the first dataset


def test_compact_handles_escaped_and_null_partition_values(spark, root):
    df = spark.createDataFrame([("a/b=c", 1), (None, 2)], "pool_name string, id int")
    for _ in range(4):
        staging.write(df, root, "odd")
    assert staging.compact(spark, root, "odd", max_files=2) == 2
    back = staging.read(spark, root, "odd")
    assert sorted((r.pool_name or "", r.id) for r in back.collect()) == \
        [("", 2)] * 4 + [("a/b=c", 1)] * 4
    assert all(n == 1 for _, n in staging._leaf_partitions(spark, f"{root}/odd"))


def test_views_follow_the_folder(spark, root):
    """A pool staged after registration shows; types stay; JSON folders work."""
    import os
    group = os.path.join(root, catalog.CATEGORIES["dedicated"])
    make = lambda pool, n: spark.createDataFrame([(pool, n, dt.datetime(2024, 1, 1, 0, 0, 0, 7))], "pool_name string, n int, at timestamp_ntz")
    for name, fmt in (("plain", "parquet"), ("texts", "json")):
        staging.write(make("007", 1), group, name, fmt=fmt)
    made = catalog.register_views(spark, root, "estate_follow_test")
    assert made == ["estate_follow_test.dedicated_plain", "estate_follow_test.dedicated_texts"]
    for name, fmt in (("plain", "parquet"), ("texts", "json")):
        staging.write(make("8", 2).withColumn("extra", F.lit("x")), group, name, fmt=fmt)
        rows = spark.table(f"estate_follow_test.dedicated_{name}").orderBy("n").collect()
        assert [tuple(r) for r in rows] == [(1, dt.datetime(2024, 1, 1, 0, 0, 0, 7), "007"), (2, dt.datetime(2024, 1, 1, 0, 0, 0, 7), "8")]
    odd = ["a/b", "x+y z", "50%", None]
    for v in odd:
        staging.write(make(v, 3), group, "plain")
    got = {r.pool_name for r in spark.table("estate_follow_test.dedicated_plain").filter("n = 3").collect()}
    assert got == set(odd)
