"""Incremental extract as a Structured Streaming query.

The source view keeps only its latest records, so the extract is re-run
hourly and appends what is new.  Here each run's snapshot of the source
lands as files in a folder; a file stream over that folder, started with
``trigger(availableNow=True)``, processes the snapshots not yet seen (the
checkpoint remembers them), and ``foreachBatch`` stages every micro-batch's
rows that lie above the per-pool high-water mark of what is already staged.

The checkpoint and the staged data live in shared storage, so a restarted
driver or a lost executor resumes from the last committed batch.  A micro-batch is
one batch of :mod:`estate.sources.batches`, named after the stream and its number:
rows, marks and report partials become visible in one commit, and a micro-batch
that is replayed after that (failure before the checkpoint's own commit) finds its
name in the log and writes nothing.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate.operators import analysis, incremental
from estate.sources import batches, staging


def stage_new_rows(spark: SparkSession, batch: DataFrame, root: str, dataset: str,
                   mark_col: str, keys: Sequence[str] = ("pool_name",),
                   transform: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
                   partition_by: Sequence[str] = ("pool_name",),
                   report: str | None = None, batch_id: str | None = None,
                   marks: DataFrame | None = None, fixed_marks: bool = False) -> int:
    """One incremental step (batch form of T1): marks from the marks log (or the
    given ones, with ``fixed_marks``), keep rows above them, append.
    ``transform(raw, marks)`` turns raw rows into the staged form and applies the
    mark (default: mark filter only).

    The new rows, their marks and, with ``report`` (a dataset name), the partial
    request-window rows made of them are committed together
    (:func:`estate.sources.batches.append`), so the report counts exactly what was
    staged; a ``batch_id`` that is committed already writes nothing."""
    if not fixed_marks:
        marks = batches.marks(spark, root, dataset, mark_col, keys)
    new = incremental.newer_than(batch, mark_col, marks, keys) if transform is None else transform(batch, marks)
    reports = {report: lambda rows: analysis.request_window_parts(rows, tuple(keys))} if report else {}
    return batches.append(spark, root, dataset, new, mark_col, keys, partition_by, batch_id, reports)


RUNNING = "_running"             # suffix of a dataset's requests that haven't finished


def stage_with_running(spark: SparkSession, batch: DataFrame, root: str, dataset: str, mark_col: str,
                       keys: Sequence[str], request_key: Sequence[str],
                       transform: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
                       partition_by: Sequence[str] = ("pool_name",), report: str | None = None,
                       batch_id: str | None = None, marks: DataFrame | None = None, fixed_marks: bool = False,
                       start_col: str = "start_time", forget: str | None = None) -> int:
    """T2 on the stream: requests still running (null ``mark_col``) are kept as state
    beside the dataset and replaced when they finish, however late that is seen.

    The dataset gets the finished requests above their mark, and those that were in
    the state, whatever their mark.  The state becomes: the requests of this snapshot
    that still run, and earlier ones that it doesn't show.  The latter are given up
    (moved to the dataset as they are) once they started more than ``forget`` (an
    interval) before their key's mark, which bounds the state; ``None`` keeps them.
    Rows, marks and the new state become visible in one commit."""
    if not fixed_marks:
        marks = batches.marks(spark, root, dataset, mark_col, keys)
    shown = batch if transform is None else transform(batch, None)
    finished = incremental.keep_newest(shown, request_key, mark_col).filter(F.col(mark_col).isNotNull())
    running = shown.filter(F.col(mark_col).isNull()).join(*_on(finished, request_key), "left_anti").dropDuplicates(list(request_key))
    new, before = incremental.newer_than(finished, mark_col, marks, keys), staging.read(spark, root, dataset + RUNNING)
    if before is not None:
        late = finished.join(*_on(before, request_key), "left_semi")
        new = new.join(*_on(before, request_key), "left_anti").unionByName(late)
        unseen = before.join(*_on(shown, request_key), "left_anti")
        if forget is not None and marks is not None:
            given_up = unseen.join(*_on(incremental.newer_than(unseen, start_col, marks, keys, forget), request_key), "left_anti")
            new = new.unionByName(given_up, allowMissingColumns=True)
            unseen = unseen.join(*_on(given_up, request_key), "left_anti")
        running = running.unionByName(unseen, allowMissingColumns=True)
    reports = {report: lambda rows: analysis.request_window_parts(rows, tuple(keys))} if report else {}
    return batches.append(spark, root, dataset, new, mark_col, keys, partition_by, batch_id, reports, {dataset + RUNNING: running})


def _on(other: DataFrame, key: Sequence[str]):
    """The other side and the null-safe condition of a join on ``key``."""
    cond = F.lit(True)
    for c in key:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return other.select(*[F.col(c).alias(f"_o_{c}") for c in key]).distinct(), cond


def current(spark: SparkSession, root: str, dataset: str) -> DataFrame | None:
    """Every request once: the finished ones and those that still run."""
    done, running = staging.read(spark, root, dataset), staging.read(spark, root, dataset + RUNNING)
    return done if done is None or running is None else done.unionByName(running, allowMissingColumns=True)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the stream's checkpoint keeps (it survives restarts)."""
    return json.loads(staging._read_text(spark, os.path.join(checkpoint, "metadata")))["id"]


def start_stream(spark: SparkSession, source_dir: str, schema: T.StructType, root: str,
                 dataset: str, mark_col: str, checkpoint: str, keys: Sequence[str] = ("pool_name",),
                 transform: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
                 partition_by: Sequence[str] = ("pool_name",), fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, every: str | None = None,
                 on_batch: Callable[[int, int], None] | None = None, report: str | None = None,
                 request_key: Sequence[str] | None = None, forget: str | None = None):
    """Start the incremental file stream and return the ``StreamingQuery``.

    ``every=None`` processes what is available and stops
    (``trigger(availableNow=True)``); ``every='1 hour'`` keeps running and
    stages new snapshots at that cadence, like the hourly extract job.
    ``max_files_per_trigger`` cuts the available snapshot into several
    micro-batches; the marks are then those from before the snapshot for all
    of them (kept beside the checkpoint until the snapshot is done, also
    across a restart), as the first micro-batch's rows must not hide later
    files.  It needs ``every=None``, where the snapshot is known.
    ``on_batch(batch_id, rows)`` is called after each staged micro-batch.
    ``request_key`` keeps requests that still run as state
    (:func:`stage_with_running`, with ``forget``).
    """
    if max_files_per_trigger and every is not None:
        raise ValueError("max_files_per_trigger needs every=None: a running stream can't tell snapshots apart")
    fixed = bool(max_files_per_trigger)
    marks = _snapshot_marks(spark, root, dataset, mark_col, keys, checkpoint) if fixed else None

    def each(batch: DataFrame, batch_id: int) -> None:
        label = f"stream-{_stream_id(spark, checkpoint)}-{batch_id:08d}"
        if request_key:
            n = stage_with_running(spark, batch, root, dataset, mark_col, keys, request_key, transform, partition_by,
                                   report, label, marks, fixed, forget=forget)
        else:
            n = stage_new_rows(spark, batch, root, dataset, mark_col, keys, transform, partition_by,
                               report, label, marks, fixed)
        if on_batch:
            on_batch(batch_id, n)

    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.load(source_dir).writeStream.foreachBatch(each)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def _marks_folder(checkpoint: str) -> str:
    return checkpoint.rstrip("/") + "_marks"


def _snapshot_marks(spark, root, dataset, mark_col, keys, checkpoint) -> DataFrame | None:
    """The marks from before the snapshot; a first run stores an empty table."""
    folder = _marks_folder(checkpoint)
    if not staging._exists(spark, folder):
        marks = batches.marks(spark, root, dataset, mark_col, keys)
        if marks is None:
            return None                      # nothing staged yet: everything is new
        marks.write.parquet(folder)
    return spark.read.parquet(folder)


def stream_new(spark: SparkSession, source_dir: str, schema: T.StructType, root: str,
               dataset: str, mark_col: str, checkpoint: str, keys: Sequence[str] = ("pool_name",),
               transform: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
               partition_by: Sequence[str] = ("pool_name",), fmt: str = "parquet",
               max_files_per_trigger: int | None = None, report: str | None = None,
               request_key: Sequence[str] | None = None, forget: str | None = None) -> list[int]:
    """Run the file stream over ``source_dir`` until everything available is
    processed; return the number of rows staged per micro-batch."""
    written: list[int] = []
    query = start_stream(spark, source_dir, schema, root, dataset, mark_col, checkpoint, keys,
                         transform, partition_by, fmt, max_files_per_trigger,
                         on_batch=lambda _bid, n: written.append(n), report=report,
                         request_key=request_key, forget=forget)
    query.awaitTermination()
    staging.remove(spark, _marks_folder(checkpoint))     # this snapshot is done
    return written
