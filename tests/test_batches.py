"""Batches: marks log, all-or-nothing commits, compaction, prunable relations."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from estate.operators import analysis, incremental
from estate.plans import catalog, run
from estate.sources import activity, batches, staging, tables

from conftest import SF_SMALL

KEYS = ["workspace_name", "pool_name"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _parts(spark):
    raw = tables.requests(spark, SF_SMALL, with_workspace=True)
    return [raw.filter(F.dayofmonth("start_time") < d) for d in (8, 15, 40)]


def _staged(spark, root):
    rows = staging.read(spark, os.path.join(root, run.DEDICATED), "session_requests")
    return sorted(map(str, rows.select(sorted(rows.columns)).collect()))


def test_marks_equal_recomputed_maxima_and_read_no_staged_file(spark, root):
    group = os.path.join(root, run.DEDICATED)
    for raw in _parts(spark):
        run.run_all(spark, root, run.ProfileInputs(requests=raw))
        marks = batches.marks(spark, group, "session_requests", "end_time", KEYS)
        assert all("session_requests_marks" in f for f in marks.inputFiles())
        again = incremental.high_water(staging.read(spark, group, "session_requests"), "end_time", KEYS)
        assert sorted(map(tuple, marks.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    one = batches.marks(spark, group, "session_requests", "end_time", KEYS, scope="global").collect()
    assert [tuple(r) for r in one] == [(max(r[2] for r in marks.collect()),)]


@pytest.mark.parametrize("failing", ["session_requests", "session_requests_marks", run.WINDOW_PARTS, "commit"])
def test_failure_after_each_write_changes_nothing(spark, root, failing, monkeypatch):
    first, _, last = _parts(spark)
    other = os.path.join(root, "other")
    here = os.path.join(root, "here")
    for r in (here, other):
        run.run_all(spark, r, run.ProfileInputs(requests=first))
    before = _staged(spark, here), run.request_windows(spark, here).collect()
    write, append_log = batches.Batch.write, batches._append_log

    def broken(self, df, dataset, *a, **k):
        n = write(self, df, dataset, *a, **k)
        if dataset == failing:
            raise OSError("lost")
        return n

    def no_log(*a):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(batches.Batch, "write", broken)
        if failing == "commit":
            m.setattr(batches, "_append_log", no_log)
        with pytest.raises(OSError):
            run.run_all(spark, here, run.ProfileInputs(requests=last))
    assert (_staged(spark, here), run.request_windows(spark, here).collect()) == before     # nothing half-done is seen
    for r in (here, other):
        run.run_all(spark, r, run.ProfileInputs(requests=last))
    assert append_log is batches._append_log
    assert _staged(spark, here) == _staged(spark, other)
    assert run.request_windows(spark, here).collect() == run.request_windows(spark, other).collect()
    group = os.path.join(here, run.DEDICATED)
    folders = [n for n in catalog._list_dirs(spark, os.path.join(group, "session_requests")) if staging.TEXT_MARK not in n]
    assert len(folders) == len(batches.live(spark, group, "session_requests")) == 2     # leftovers are gone


def test_committed_batch_is_not_written_again(spark, root):
    df = spark.createDataFrame([(1, "p", dt.datetime(2024, 1, 1)), (2, None, None)], "id int, pool_name string, end_time timestamp_ntz")
    for _ in range(2):
        assert batches.append(spark, root, "r", df, "end_time", ["pool_name"], ["pool_name"], "stream-00000001") == 2
    assert staging.read(spark, root, "r").count() == 2
    assert sorted(map(tuple, batches.marks(spark, root, "r", "end_time", ["pool_name"]).collect()), key=str) == [
        ("p", dt.datetime(2024, 1, 1)), (None, None)]


def test_compaction_keeps_rows_marks_and_report(spark, root):
    inputs = _parts(spark)
    settings = run.ProfileSettings(compact_max_batches=2)
    for raw in inputs:
        run.run_all(spark, root, run.ProfileInputs(requests=raw), settings)
    other = os.path.join(root, "plain")
    for raw in inputs:
        run.run_all(spark, other, run.ProfileInputs(requests=raw))
    group = os.path.join(root, run.DEDICATED)
    for dataset in ("session_requests", "session_requests_marks", run.WINDOW_PARTS):
        assert len(batches.live(spark, group, dataset)) == 1
    assert _staged(spark, root) == _staged(spark, other)
    assert run.request_windows(spark, root).collect() == run.request_windows(spark, other).collect()
    assert run.request_windows(spark, root).collect() == analysis.request_window(
        staging.read(spark, group, "session_requests"), by=("workspace_name", "pool_name")).collect()
    # a further run starts from the merged marks: only requests of pools without a mark come again
    n = run.run_all(spark, root, run.ProfileInputs(requests=inputs[-1]))["session_requests"]
    marks = batches.marks(spark, group, "session_requests", "end_time", KEYS)
    assert n == activity.dedicated_requests(inputs[-1], marks=marks, keys=KEYS).count()


def test_commit_log_compaction(spark, root):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "id int, end_time timestamp_ntz")
    for i in range(4):
        batches.append(spark, root, "r", df.withColumn("id", F.lit(i)), "end_time", ["id"], [])
    batches.compact(spark, root, "r", 3)
    assert batches.compact_log(spark, root, max_files=3) and not batches.compact_log(spark, root, max_files=3)
    assert sorted(r.id for r in staging.read(spark, root, "r").collect()) == [0, 1, 2, 3]
    assert len(batches.live(spark, root, "r")) == 1 and len(batches.live(spark, root, "r_marks")) == 4
    batches.clean(spark, root, ["r"])
    assert len([n for n in catalog._list_dirs(spark, os.path.join(root, "r")) if staging.TEXT_MARK not in n]) == 1
    assert sorted(r.id for r in staging.read(spark, root, "r").collect()) == [0, 1, 2, 3]


def test_root_without_a_log_is_read_once_for_marks(spark, root):
    df = spark.createDataFrame([(1, "p", dt.datetime(2024, 1, 1))], "id int, pool_name string, end_time timestamp_ntz")
    assert batches.marks(spark, root, "old", "end_time", ["pool_name"]) is None
    staging.write(df, root, "old")
    assert [tuple(r) for r in batches.marks(spark, root, "old", "end_time", ["pool_name"]).collect()] == [("p", dt.datetime(2024, 1, 1))]


def test_analyzer_relations_prune_and_stay_text(spark, root):
    group = os.path.join(root, run.DEDICATED)
    rows = spark.createDataFrame([(1, "007"), (2, "12"), (3, "+8"), (4, None)], "id int, pool_name string")
    staging.write(rows, group, "tables", mode="overwrite")
    when = rows.withColumn("end_time", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    batches.append(spark, group, "session_requests", when, "end_time", ["pool_name"], ["pool_name"])
    batches.Batch(spark, group).write(when, "session_requests", ["pool_name"])              # never committed
    names = catalog.register_views(spark, root, "estate_prune")
    assert names == ["estate_prune.dedicated_session_requests", "estate_prune.dedicated_tables"]
    for name in names:
        df = spark.table(name)
        assert df.schema["pool_name"].dataType.simpleString() == "string"
        assert sorted((r.id, r.pool_name) for r in df.collect()) == [(1, "007"), (2, "12"), (3, "+8"), (4, None)]
        some = df.filter("pool_name = '12'")
        filters = _plan(some).split("PartitionFilters: [")[1].split("]")[0]
        assert "pool_name" in filters and "12" in filters
        assert [r.id for r in some.collect()] == [2] and [r.id for r in df.filter("pool_name = '007'").collect()] == [1]
    staging.write(spark.createDataFrame([(9, "pool_9")], "id int, pool_name string"), group, "tables")
    batches.append(spark, group, "session_requests", when.filter("id = 1").withColumn("pool_name", F.lit("pool_9")),
                   "end_time", ["pool_name"], ["pool_name"])
    for name in names:                                                                      # later pools appear
        assert spark.table(name).filter("pool_name = 'pool_9'").count() == 1
