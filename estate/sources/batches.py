"""Batches: everything that one append writes becomes visible together.

An appended dataset lies in ``root/<dataset>/estate_batch=<id>/<partition>=<value>/``.
A batch writes its rows, its marks and its report rows under one id, each into
its own dataset, and then appends one small file to ``root/_commits`` that names
them all: that file's appearance is the commit.  Readers
(:func:`estate.sources.staging.read`) see the committed batches only, as a partition
filter, so

* a run that fails between two writes leaves nothing to be seen; the next run
  starts from the same marks, writes the same rows again and removes the leftovers;
* a replayed micro-batch has its id in the log already and writes nothing.

**Marks log.**  With the rows goes one row per key: the greatest value of the mark
column and the number of rows.  Maxima merge, so the high-water marks of a
dataset are the maxima over the marks of its batches (:func:`marks`); no
staged data file is read for them, however long the history.

**Compaction.**  Once more than ``max_batches`` small batches are live, their rows are
written as one batch, which the same commit adds while it drops the old ones.

One writer appends to a dataset at a time; readers may run at any time except for
the moment in which :func:`clean` deletes folders that no commit names any more.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estate.operators.incremental import MARK
from estate.sources import staging

COMMITS = "_commits"
BATCH = staging.BATCH
MARKS = "_marks"                 # suffix of a dataset's marks log
SMALL_ROWS = 1_000_000           # batches up to this size are merged
COMMIT_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType(), False),
    T.StructField("batch_id", T.StringType(), False),
    T.StructField("action", T.StringType(), False),          # add, drop
    T.StructField("num_recs", T.LongType(), False),
    T.StructField("committed_at", T.TimestampNTZType(), False),
])


def log(spark: SparkSession, root: str) -> DataFrame:
    """The commit log of a staging root (empty when nothing was committed)."""
    path = os.path.join(root, COMMITS)
    if not staging._exists(spark, path):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).parquet(path)


def live(spark: SparkSession, root: str, dataset: str) -> dict[str, int]:
    """Rows of each committed batch of ``dataset`` that no later commit dropped;
    their number stays bounded by :func:`compact`."""
    if not staging._exists(spark, os.path.join(root, COMMITS)):
        return {}
    return {r.batch_id: r.n for r in
            log(spark, root).filter(F.col("dataset") == dataset).groupBy("batch_id")
            .agg(F.max(F.col("action") == "drop").alias("dropped"), F.max("num_recs").alias("n"))
            .filter("NOT dropped").select("batch_id", "n").collect()}


def _append_log(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    (spark.createDataFrame([(*r, now) for r in rows], COMMIT_SCHEMA).coalesce(1)
     .write.mode("append").parquet(os.path.join(root, COMMITS)))


class Batch:
    """One batch under ``root``; nothing of it is visible before :meth:`commit`."""

    def __init__(self, spark: SparkSession, root: str, batch_id: str | None = None):
        self.spark, self.root = spark, root
        self.id = batch_id or f"run-{uuid.uuid4().hex[:16]}"       # ids are text in any case, not numbers
        self.counts: dict[str, int] = {}

    def _folder(self, dataset: str) -> str:
        return os.path.join(self.root, dataset, f"{BATCH}={self.id}")

    def write(self, df: DataFrame, dataset: str, partition_by: Sequence[str] = (), rebalance: bool = True) -> int:
        """Write rows of the batch, replacing those of an attempt that failed."""
        staging.remove(self.spark, self._folder(dataset))
        n = staging.write(df.withColumn(BATCH, F.lit(self.id)), self.root, dataset, mode="append",
                          partition_by=(BATCH, *partition_by), rebalance=rebalance and bool(partition_by))
        self.counts[dataset] = n
        return n

    def rows(self, dataset: str) -> DataFrame:
        """The batch's own rows of ``dataset``, before or after the commit."""
        return staging.read_batches(self.spark, self.root, dataset, [self.id])

    def write_marks(self, dataset: str, col: str, keys: Sequence[str]) -> None:
        """The batch's entry in the marks log of ``dataset``: one row per key."""
        part = self.rows(dataset).groupBy(*keys).agg(F.max(col).alias(MARK), F.count(F.lit(1)).alias("num_recs"))
        self.write(part, dataset + MARKS)

    def commit(self, drop: dict[str, Sequence[str]] | None = None) -> None:
        """Make all that the batch wrote visible; with ``drop``, take batches of
        the named datasets out in the same step."""
        rows = [(d, self.id, "add", n) for d, n in self.counts.items()]
        rows += [(d, b, "drop", 0) for d, ids in (drop or {}).items() for b in ids]
        _append_log(self.spark, self.root, rows)


def marks(spark: SparkSession, root: str, dataset: str, col: str, keys: Sequence[str],
          scope: str = "key") -> DataFrame | None:
    """A3 from the marks log: the greatest ``col`` per key, or over all keys
    (``scope='global'``).  ``None`` when nothing was staged.  A dataset that was
    staged without a log is read once for its marks."""
    from estate.operators import incremental
    entries = staging.read(spark, root, dataset + MARKS)
    if entries is None or MARK not in entries.columns:
        staged = staging.read(spark, root, dataset)
        return None if staged is None else incremental.high_water(staged, col, keys, scope=scope)
    if not live(spark, root, dataset):
        return None
    return incremental.high_water(entries, MARK, keys, scope=scope)


def append(spark: SparkSession, root: str, dataset: str, df: DataFrame, mark_col: str, keys: Sequence[str],
           partition_by: Sequence[str], batch_id: str | None = None,
           reports: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
           state: dict[str, DataFrame] | None = None) -> int:
    """One batch of an incremental dataset: its rows, its marks and the report
    rows that ``reports`` (dataset name -> function of the batch's rows) make of
    them, committed together.  ``state`` datasets hold the rows of the last batch
    only: the commit that adds them drops their earlier batches.  A batch whose id
    is committed already writes nothing and returns its rows' number."""
    schema = staging._load_schema(spark, os.path.join(root, dataset))
    if schema is not None and BATCH not in schema.names:
        raise ValueError(f"{dataset} was staged without batches: stage it anew under another root")
    done = live(spark, root, dataset)
    if batch_id in done:
        return done[batch_id]
    clean(spark, root, [dataset, dataset + MARKS, *(reports or {}), *(state or {})])
    batch = Batch(spark, root, batch_id)
    n = batch.write(df, dataset, partition_by)
    batch.write_marks(dataset, mark_col, keys)
    for name, made in (reports or {}).items():
        batch.write(made(batch.rows(dataset)), name)
    old = {name: list(live(spark, root, name)) for name in state or {}}
    for name, df in (state or {}).items():
        batch.write(df, name)
    batch.commit(drop=old)
    return n


def clean(spark: SparkSession, root: str, datasets: Sequence[str]) -> int:
    """Delete batch folders that no commit names: of failed attempts and of
    batches that a compaction dropped.  Returns how many."""
    gone = 0
    for dataset in datasets:
        h = staging._fs(spark, os.path.join(root, dataset))
        if h is None or not h[0].exists(h[1]):
            continue
        kept = {*live(spark, root, dataset), staging.TEXT_MARK}
        for st in h[0].listStatus(h[1]):
            name = st.getPath().getName()
            if name.startswith(BATCH + "=") and name.split("=", 1)[1] not in kept:
                gone += bool(h[0].delete(st.getPath(), True))
    return gone


def compact(spark: SparkSession, root: str, dataset: str, max_batches: int = 64, partition_by: Sequence[str] = (),
            merge: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Merge the small batches of ``dataset`` once more than ``max_batches`` of
    them are live; ``merge`` may shrink their rows (marks, report partials).
    Returns the number of batches merged."""
    small = [b for b, n in live(spark, root, dataset).items() if n <= SMALL_ROWS]
    if len(small) <= max_batches:
        return 0
    rows = staging.read_batches(spark, root, dataset, small)
    batch = Batch(spark, root)
    batch.write(rows if merge is None else merge(rows), dataset, partition_by)
    batch.commit(drop={dataset: small})
    return len(small)


def merged_marks(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """For :func:`compact`: one marks row per key."""
    return lambda df: df.groupBy(*keys).agg(F.max(MARK).alias(MARK), F.sum("num_recs").alias("num_recs"))


def compact_log(spark: SparkSession, root: str, max_files: int = 256) -> bool:
    """Write the log as one file once it has more than ``max_files``.  The new
    file is appended first and the old ones go one by one: rows count once however often
    they stand in the log, so a stop at any point loses nothing."""
    h = staging._fs(spark, os.path.join(root, COMMITS))
    if h is None or not h[0].exists(h[1]):
        return False
    old = [st.getPath() for st in h[0].listStatus(h[1]) if st.isFile() and st.getPath().getName().endswith(".parquet")]
    if len(old) <= max_files:
        return False
    (log(spark, root).groupBy("dataset", "batch_id", "action").agg(F.max("num_recs").alias("num_recs"), F.max("committed_at").alias("committed_at"))
     .coalesce(1).write.mode("append").parquet(os.path.join(root, COMMITS)))
    for path in old:
        h[0].delete(path, False)
    return True
