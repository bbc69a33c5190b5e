"""Staged datasets: typed writes, restartable steps, reads.

Layout: ``root/<workspace>/<group>/<dataset>/<partition>=<value>/part-*``.
The root is a folder in shared storage (see :func:`estate.session.shared_dir`).

* Writes are Parquet (JSON on request) through Spark's commit protocol, so a
  lost executor only re-runs its task and a failed job leaves no visible
  partial files.  ``overwrite`` uses dynamic partition overwrite: only the
  partitions present in the new data (one pool, one day) are replaced.
* The row count of a write is taken by an ``Observation`` in the same pass,
  not by a second action.
* A step is done when the ``_steps`` dataset holds a row for it; the row is
  appended only after the data write committed.  Re-running a done step
  writes nothing.
* Datasets that grow by appends are written in batches
  (:mod:`estate.sources.batches`); reads see the committed batches only.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import re
from functools import reduce
from urllib.parse import unquote
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

STEPS = "_steps"
BATCH = "estate_batch"           # partition column of datasets written in batches (see batches.py)
STEP_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType(), False),
    T.StructField("partition", T.StringType(), True),
    T.StructField("num_recs", T.LongType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("finished_at", T.TimestampNTZType(), False),
])


def dataset_path(root: str, dataset: str) -> str:
    return os.path.join(root, dataset)


SCHEMA_FILE = "_estate_schema.json"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"   # Spark's folder name for a null value
TEXT_MARK = "~text"                             # value of a folder without rows
_TEXT = re.compile(r"^[g-zG-Z_]|^[a-fA-F][^0-9]*[g-zG-Z_~]|^~")   # neither number nor time

# Text formats are written with microseconds (Spark's JSON default writes
# milliseconds); reading needs no pattern.
TEXT_TIME_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def _format_options(fmt: str) -> dict[str, str]:
    return TEXT_TIME_OPTIONS if fmt in ("json", "csv") else {}


def _fs(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) for ``path``; ``None`` when the session has
    no JVM gateway (a Spark Connect client)."""
    try:
        jvm = spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath
    except Exception:   # no py4j gateway: Connect session
        return None


def _exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists in the (possibly remote) file system."""
    h = _fs(spark, path)
    if h is not None:
        return bool(h[0].exists(h[1]))
    try:
        spark.read.format("binaryFile").load(path).limit(0).collect()
        return True
    except AnalysisException as e:      # anything else is not "absent" and must be seen
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep the declared schema next to the data (a ``_`` file, which Spark
    readers skip), so reads need no inference and empty datasets stay typed."""
    h = _fs(spark, os.path.join(path, SCHEMA_FILE))
    if h is None:
        return
    out = h[0].create(h[1], True)
    try:
        out.write(bytearray(schema.json().encode("utf-8")))
    finally:
        out.close()


def _load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = _read_text(spark, os.path.join(path, SCHEMA_FILE))
    return None if text is None else T.StructType.fromJson(json.loads(text))


def _read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, ``None`` if it doesn't exist."""
    h = _fs(spark, path)
    if h is None or not h[0].exists(h[1]):
        return None
    stream = h[0].open(h[1])
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write(df: DataFrame, root: str, dataset: str, mode: str = "append",
          partition_by: Sequence[str] = ("pool_name",), fmt: str = "parquet",
          max_records_per_file: int = 5_000_000, rebalance: bool = True) -> int:
    """K1: write ``df`` under ``root/dataset`` partitioned by ``partition_by``
    and return the number of rows written.

    ``overwrite`` replaces only the partitions present in ``df`` (dynamic
    partition overwrite); ``append`` adds files.

    ``rebalance`` (default) shuffles rows by the partition columns with the
    ``rebalance`` hint: AQE then splits the shuffle partition of a pool that
    holds a large share of the rows over several tasks and coalesces small
    ones, so each pool folder gets a few well-sized files instead of one
    file per input task.  ``rebalance=False`` skips the shuffle (every task
    writes its own rows - more, smaller files).  ``maxRecordsPerFile`` bounds
    file size either way.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    obs = Observation(f"write_{dataset}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    path = dataset_path(root, dataset)
    (observed.write
     .mode(mode)
     .format(fmt)
     .options(**_format_options(fmt))
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*partition_by)
     .save(path))
    data = [f for f in df.schema.fields if f.name not in partition_by]
    parts = [T.StructField(f.name, f.dataType, True) for c in partition_by
             for f in df.schema.fields if f.name == c]
    if mode == "append" or partition_by:
        # Earlier writes (and the partitions that a dynamic overwrite
        # leaves alone) may carry columns this one lacks; keep them (read back
        # as null for the new rows), as unionByName would.
        earlier = _load_schema(df.sparkSession, path)
        if earlier is not None:
            names = {f.name for f in data + parts}
            data += [T.StructField(f.name, f.dataType, True) for f in earlier.fields
                     if f.name not in names]
    _save_schema(df.sparkSession, path, T.StructType(data + parts))
    _mark_text_folders(df.sparkSession, path, T.StructType(data), parts, fmt)
    return int(obs.get["rows"])


def _mark_text_folders(spark: SparkSession, path: str, data: T.StructType, parts: list[T.StructField], fmt: str) -> None:
    """A partition folder without rows whose text values are no numbers: readers
    that discover partition types from the folders (the analyzer's views) then
    take ``007`` as text, whatever values the dataset has."""
    texts = [i for i, f in enumerate(parts) if isinstance(f.dataType, T.StringType)]
    h = _fs(spark, path)
    if h is None or not texts or not h[0].exists(h[1]):
        return
    fs, folder = h
    # down one branch: a value that can't be a number makes its level text already
    for i in range(len(parts)):
        below = [st.getPath() for st in fs.listStatus(folder) if st.isDirectory() and "=" in st.getPath().getName()]
        values = [p.getName().split("=", 1)[1] for p in below]
        if not below or i in texts and not any(_TEXT.search(v) and v != NULL_PARTITION for v in values):
            break
        folder = below[0]
    else:
        return
    marked = os.path.join(path, *[f"{f.name}={TEXT_MARK if i in texts else NULL_PARTITION}" for i, f in enumerate(parts)])
    if not _exists(spark, marked):
        spark.createDataFrame([], data).coalesce(1).write.mode("overwrite").format(fmt).save(marked)


def read(spark: SparkSession, root: str, dataset: str, schema: T.StructType | None = None,
         fmt: str = "parquet", partition_types: dict[str, T.DataType] | None = None) -> DataFrame | None:
    """Read a staged dataset with partition discovery; ``None`` when the
    dataset does not exist yet.

    The schema is, in order of preference: ``schema``; the one recorded by
    :func:`write`; the files' own, with partition columns read as strings
    (or ``partition_types``), never inferred - so ``pool_name=007`` stays
    ``'007'``.  A dataset whose writes produced no rows reads as empty.
    """
    path = dataset_path(root, dataset)
    if not _exists(spark, path):
        return None
    if schema is None:
        schema = _load_schema(spark, path)
        if schema is not None and partition_types:
            schema = T.StructType([T.StructField(f.name, partition_types.get(f.name, f.dataType),
                                                 True) for f in schema.fields])
    if schema is None:
        probe = spark.read.format(fmt).load(path).schema
        part_cols = _partition_columns(spark, path)
        types = partition_types or {}
        schema = T.StructType([
            T.StructField(f.name, types.get(f.name, T.StringType()), True)
            if f.name in part_cols else f
            for f in probe.fields])
    # Reads keep Spark's lenient ISO-8601 parsing (any fraction, zones).
    df = spark.read.schema(schema).format(fmt).load(path)
    if BATCH in schema.names:
        from estate.sources import batches
        return _of_batches(df, list(batches.live(spark, root, dataset)))
    return df


def _of_batches(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Rows of the given batches (a partition filter), without the batch column."""
    return df.filter(F.col(BATCH).isin(list(ids)) if ids else F.lit(False)).drop(BATCH)


def read_batches(spark: SparkSession, root: str, dataset: str, ids: Sequence[str]) -> DataFrame:
    """Rows of named batches of a dataset, committed or not; their folders alone
    are listed."""
    path = dataset_path(root, dataset)
    schema = _load_schema(spark, path)
    folders = [f for f in (os.path.join(path, f"{BATCH}={i}") for i in ids) if _exists(spark, f)]
    if not folders:                  # a batch without rows has no folder
        return spark.createDataFrame([], schema).drop(BATCH)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).drop(BATCH)


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``key=value`` folder levels under ``path``, outermost first."""
    h = _fs(spark, path)
    if h is None:
        return []
    fs, jpath = h
    cols: list[str] = []
    level = [jpath]
    while level:
        nxt = []
        for p in level:
            for st in fs.listStatus(p):
                name = st.getPath().getName()
                if st.isDirectory() and "=" in name and not name.startswith(("_", ".")):
                    if name.split("=", 1)[0] not in cols:
                        cols.append(name.split("=", 1)[0])
                    nxt.append(st.getPath())
        level = nxt[:1]   # one branch is enough to learn the level names
    return cols


# --- steps (K2-K4) -----------------------------------------------------------

def steps(spark: SparkSession, root: str) -> DataFrame:
    """K4: the step state of a staging root (empty when nothing ran)."""
    df = read(spark, root, STEPS, schema=STEP_SCHEMA) if _exists(
        spark, dataset_path(root, STEPS)) else None
    return df if df is not None else spark.createDataFrame([], STEP_SCHEMA)


def step_done(spark: SparkSession, root: str, dataset: str, partition: str | None = None) -> bool:
    """K4: has this step (dataset, optional ``key=value`` partition) finished?"""
    if not _exists(spark, dataset_path(root, STEPS)):      # nothing ever finished
        return False
    st = steps(spark, root).filter((F.col("dataset") == dataset) & (F.col("status") == "done"))
    st = st.filter(F.col("partition").isNull() if partition is None else F.col("partition") == partition)
    return st.limit(1).count() > 0


def pending_partitions(spark: SparkSession, root: str, dataset: str,
                       partitions: Iterable[str]) -> list[str]:
    """K3: which of the wanted ``key=value`` partitions have no finished step.
    Only the done steps among the wanted ones are read back, so what reaches
    the driver is bounded by the wanted list."""
    wanted = list(partitions)
    if not _exists(spark, dataset_path(root, STEPS)):      # nothing ever finished
        return sorted(wanted)
    done = {r.partition for r in steps(spark, root)
            .filter((F.col("dataset") == dataset) & (F.col("status") == "done")
                    & F.col("partition").isin(wanted))
            .select("partition").distinct().collect()}
    return sorted(p for p in wanted if p not in done)


def _mark_done(spark: SparkSession, root: str, dataset: str, partition: str | None,
               num_recs: int) -> None:
    row = [(dataset, partition, int(num_recs), "done",
            _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))]
    (spark.createDataFrame(row, STEP_SCHEMA).coalesce(1)
     .write.mode("append").parquet(dataset_path(root, STEPS)))


def write_step(spark: SparkSession, root: str, dataset: str,
               df_fn: Callable[[], DataFrame], partition: str | None = None,
               partition_by: Sequence[str] = ("pool_name",), fmt: str = "parquet") -> int | None:
    """K2 / K3: run ``df_fn`` and stage its rows unless the step is done.

    Returns the number of rows written, or ``None`` when skipped.  A partial
    earlier attempt left no committed files (commit protocol), and the
    overwrite of the step's own partitions replaces anything it did commit.
    ``partition`` is the ``key=value`` label of a partitioned step
    (e.g. ``last_upd=2024-01-02``).
    """
    if step_done(spark, root, dataset, partition):
        return None
    n = write(df_fn(), root, dataset, mode="overwrite", partition_by=partition_by, fmt=fmt)
    _mark_done(spark, root, dataset, partition, n)
    return n


def write_partition_steps(spark: SparkSession, root: str, dataset: str, df: DataFrame,
                          partition_col: str, wanted: Iterable, fmt: str = "parquet") -> dict[str, int]:
    """K3 for many partitions in one write: stage the rows of every wanted
    partition value (e.g. the 59 days of run history) whose step is not done
    yet, then mark each of them done with its row count.

    Instead of one job per day, the pending values are cut from ``df`` with
    one filter, written in a single partitioned write (dynamic overwrite, so
    a half-written earlier attempt of the same day is replaced), and counted
    per partition from the committed files.  Returns ``{partition: rows}``
    for the partitions written now (empty when all were done).
    """
    labels = {f"{partition_col}={v}": v for v in wanted}
    pending = pending_partitions(spark, root, dataset, labels)
    if not pending:
        return {}
    values = [labels[p] for p in pending]
    clear_partitions(spark, root, dataset, [{partition_col: v} for v in values])   # of an unfinished attempt
    write(df.filter(F.col(partition_col).isin(values)), root, dataset, mode="overwrite",
          partition_by=(partition_col,), fmt=fmt)
    staged = read(spark, root, dataset, fmt=fmt)
    counts = {p: 0 for p in pending}     # a wanted day without rows is done too
    if staged is not None:
        written = staged.filter(F.col(partition_col).isin([str(v) for v in values]))
        for r in written.groupBy(partition_col).count().collect():   # one row per day
            counts[f"{partition_col}={r[0]}"] = int(r[1])
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(dataset, p, n, "done", now) for p, n in sorted(counts.items())]
    (spark.createDataFrame(rows, STEP_SCHEMA).coalesce(1)
     .write.mode("append").parquet(dataset_path(root, STEPS)))
    return counts


def _partition_label(keys: Sequence[str]):
    """``k=v/k=v`` of a row's keys (the label of its step)."""
    one = [F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(NULL_PARTITION))) for k in keys]
    return F.concat_ws("/", *one)


def clear_partitions(spark: SparkSession, root: str, dataset: str, partitions: Iterable[dict]) -> int:
    """Delete the folders of the given partitions (``{column: value}`` each, in
    the dataset's partition order); returns how many there were."""
    h = _fs(spark, dataset_path(root, dataset))
    if h is None:
        return 0
    fs, top = h
    if not fs.exists(top):
        return 0
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    gone = 0
    for values in partitions:
        folder = top
        for k, v in values.items():
            folder = path_of(folder, name(k, None if v is None else str(v)))
        if fs.exists(folder):
            gone += bool(fs.delete(folder, True))
    return gone


def _counts(spark, root, dataset, keys, labels: list[str]) -> dict[str, int]:
    """Row counts of the labelled partitions (one row each), from their files."""
    staged = read(spark, root, dataset)
    if staged is None:
        return {}
    rows = staged.withColumn("_label", _partition_label(keys)).filter(F.col("_label").isin(labels))
    return {r[0]: int(r[1]) for r in rows.groupBy("_label").count().collect()}


def replace_partitions(df: DataFrame, root: str, dataset: str, keys: Sequence[str], wanted: DataFrame) -> int:
    """A snapshot of the partitions in ``wanted`` (distinct ``keys``): those in
    ``df`` are replaced, and those without rows in the new snapshot are cleared,
    so nothing of an older snapshot stays.  Returns the rows written."""
    spark = df.sparkSession
    path = dataset_path(root, dataset)
    parts = [r.asDict() for r in wanted.select(*keys).distinct().collect()]     # one per pool in the run
    have = {tuple(r) for r in df.select(*keys).distinct().collect()}
    n = write(df, root, dataset, mode="overwrite", partition_by=keys)
    if _exists(spark, path):
        clear_partitions(spark, root, dataset, [w for w in parts if tuple(w[k] for k in keys) not in have])
    return n


OBSERVED_KEYS = 64


def _is_key(values: dict):
    cond = F.lit(True)
    for k, v in values.items():
        cond = cond & F.col(k).eqNullSafe(F.lit(v))
    return cond


def write_keyed_steps(spark: SparkSession, root: str,
                      wanted: Sequence[tuple[str, DataFrame, Sequence[str], list[dict]]]) -> dict[str, int | None]:
    """K2 / K3 for many datasets of one run, with one step per workspace (and pool,
    or day): ``(dataset, rows, key columns, keys asked for)`` each.

    Rows of every key asked for whose step isn't done are staged in one write per
    dataset, and the steps are marked done in one write per run, also those of the
    datasets before one that fails.  A key without rows is done too, and whatever an
    unfinished earlier attempt left of it is cleared.  Returns the rows written per
    dataset, ``None`` if all its steps were done."""
    done: set[tuple] = set()
    if _exists(spark, dataset_path(root, STEPS)):      # one row per dataset and key
        st = steps(spark, root).filter(F.col("dataset").isin([w[0] for w in wanted]) & (F.col("status") == "done"))
        done = {(r.dataset, r.partition) for r in st.select("dataset", "partition").distinct().collect()}
    out: dict[str, int | None] = {}
    marked: list[tuple] = []
    try:
        for dataset, df, keys, asked in wanted:
            parts = {_label(k, keys): k for k in asked}
            pending = {x: p for x, p in sorted(parts.items()) if (dataset, x) not in done}
            counts = _write_keys(spark, root, dataset, df, keys, pending, len(pending) == len(parts)) if pending else {}
            out[dataset] = sum(counts.values()) if pending else None
            now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            marked += [(dataset, x, counts.get(x, 0), "done", now) for x in pending]
    finally:
        if marked:
            (spark.createDataFrame(marked, STEP_SCHEMA).coalesce(1)
             .write.mode("append").parquet(dataset_path(root, STEPS)))
    return out


def _label(values: dict, keys: Sequence[str]) -> str:
    """``k=v/k=v``, as :func:`_partition_label` computes it from a row."""
    return "/".join(f"{k}={NULL_PARTITION if values[k] is None else values[k]}" for k in keys)


def _write_keys(spark, root, dataset, df, keys, pending: dict[str, dict], all_of_them: bool) -> dict[str, int]:
    """Stage the rows of the pending keys; rows written per label."""
    # what an unfinished attempt left: the overwrite would keep keys without rows now
    clear_partitions(spark, root, dataset, pending.values())
    of_key = [_is_key(p) for p in pending.values()]
    if len(pending) <= OBSERVED_KEYS:               # rows per key are counted while they are written
        obs = Observation(f"step_{dataset}")
        counted = df.filter(reduce(lambda a, b: a | b, of_key)).observe(obs, *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(of_key)])
        write(counted, root, dataset, mode="overwrite", partition_by=keys)
        return {x: int(obs.get[f"n{i}"]) for i, x in enumerate(pending)}
    if not all_of_them:
        df = df.withColumn("_label", _partition_label(keys)).filter(F.col("_label").isin(list(pending))).drop("_label")
    write(df, root, dataset, mode="overwrite", partition_by=keys)
    return _counts(spark, root, dataset, keys, list(pending))


def write_keyed_step(spark: SparkSession, root: str, dataset: str, df: DataFrame, keys: Sequence[str],
                     wanted: DataFrame) -> int | None:
    """:func:`write_keyed_steps` of one dataset; ``wanted`` holds the keys that were
    asked for, rows or not (one per workspace, pool or day)."""
    asked = [r.asDict() for r in wanted.select(*keys).distinct().collect()]
    kept = df.join(wanted.select(*[F.col(k).alias(f"_w_{k}") for k in keys]).distinct(),
                   reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys]), "left_semi")
    return write_keyed_steps(spark, root, [(dataset, kept, keys, asked)])[dataset]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own (such as a failed batch's)."""
    h = _fs(spark, path)
    if h is not None and h[0].exists(h[1]):
        h[0].delete(h[1], True)


def _data_files(spark: SparkSession, path: str) -> int:
    h = _fs(spark, path)
    if h is None or not h[0].exists(h[1]):
        return 0
    return sum(1 for st in h[0].listStatus(h[1])
               if st.isFile() and not st.getPath().getName().startswith(("_", ".")))


def compact_steps(spark: SparkSession, root: str, max_files: int = 256) -> bool:
    """Rewrite the step table as one file once it holds more than
    ``max_files`` files (each finished step appends one).  The rows are
    first stored with a reliable ``checkpoint()`` - the overwrite then reads
    the checkpoint, not the files it replaces.  Returns True if rewritten."""
    path = dataset_path(root, STEPS)
    if _data_files(spark, path) <= max_files:
        return False
    from estate.operators.joins import materialized
    rows = materialized(steps(spark, root))
    rows.coalesce(1).write.mode("overwrite").parquet(path)
    return True


def _leaf_partitions(spark: SparkSession, path: str) -> list[tuple[dict[str, str], int]]:
    """(partition values, data-file count) of every leaf partition folder."""
    h = _fs(spark, path)
    if h is None or not h[0].exists(h[1]):
        return []
    fs, top = h
    out, stack = [], [(top, {})]
    while stack:
        folder, values = stack.pop()
        files, subdirs = 0, []
        for st in fs.listStatus(folder):
            name = st.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if st.isDirectory() and "=" in name:
                k, v = name.split("=", 1)
                subdirs.append((st.getPath(), {**values, k: v}))
            elif st.isFile():
                files += 1
        if subdirs:
            stack.extend(subdirs)
        elif values:
            out.append((values, files))
    return out


def compact(spark: SparkSession, root: str, dataset: str, max_files: int = 64,
            max_partitions_per_pass: int = 200) -> int:
    """Rewrite the partitions of a staged dataset that have accumulated more
    than ``max_files`` files (hourly appends add a few each run); returns
    the number of partitions rewritten.

    Only those partitions are read; their rows are stored once with a
    reliable ``checkpoint()`` and written back with a rebalanced dynamic
    overwrite, which replaces exactly those folders.  Run it when no append
    to the same dataset is in progress."""
    from estate.operators.joins import materialized
    path = dataset_path(root, dataset)
    heavy = [v for v, n in _leaf_partitions(spark, path) if n > max_files]
    done = 0
    while heavy:
        batch, heavy = heavy[:max_partitions_per_pass], heavy[max_partitions_per_pass:]
        cond = None
        for values in batch:
            one = None
            for k, v in values.items():
                if v == NULL_PARTITION:
                    eq = F.col(k).isNull()
                else:                      # folder names are escaped (%2F, %3D, ...)
                    eq = F.col(k).cast("string") == F.lit(unquote(v))
                one = eq if one is None else one & eq
            cond = one if cond is None else cond | one
        cols = list(batch[0].keys())
        rows = materialized(read(spark, root, dataset).filter(cond))
        write(rows, root, dataset, mode="overwrite", partition_by=cols)
        done += len(batch)
    return done


def to_json_lines(df: DataFrame) -> DataFrame:
    """one JSON text per row (the form the source's dumps use)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
