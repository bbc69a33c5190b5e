"""Helpers shared by the operators: package shipping, Arrow slicing, tables."""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from estate.session import shared_dir

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()
_libc = ctypes.CDLL(None) if sys.platform == "linux" else None


def ship(spark: SparkSession) -> None:
    """Send this package's Python files to the executors (``addPyFile``), once
    per application, so that Python workers can import the operators."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="estate-ship-"), "estate_package.zip")
    root = os.path.dirname(_PACKAGE)
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a new table in the cluster's shared folder and read
    back: lineage is cut, the rows survive lost executors, and later stages
    read them without recomputing."""
    spark = df.sparkSession
    path = shared_dir(spark, "estate-llm", f"{label}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the stage table that :func:`stored` returned as ``df``; nothing
    may read it any more."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
        if "/estate-llm/" in path.toString():
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer
    referenced: its cleaner acts when the driver collects garbage, and the
    session keeps its last execution, so a small one takes that place first."""
    import gc
    spark.range(1).collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def string_parts(col: pa.Array) -> tuple[memoryview, "object"]:
    """UTF-8 bytes and int64 offsets of a string column (null: empty)."""
    import numpy as np
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    dt = np.int64 if wide else np.int32
    off = np.frombuffer(col.buffers()[1], dt)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


_tables: dict[str, dict] = {}


def tables(owner: str) -> dict:
    """What the tasks of one operator keep in their Python worker.  Workers are
    reused by later stages, so an operator's first task drops the tables of
    the others: an executor holds those of one operator at a time."""
    for other in [o for o in _tables if o != owner]:
        del _tables[other]
    return _tables.setdefault(owner, {})


def tidy() -> None:
    """Give the memory of finished batches back to the system: Arrow and the C
    library keep it otherwise, as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    if _libc is not None and hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def tidied(run, owner: str):
    """The ``mapInArrow`` function ``run`` of an operator, which leaves no
    memory of its batches in an idle worker."""
    def task(batches):
        tables(owner)
        yield from run(batches)
        tidy()
    return task


def slices(batches, max_bytes: int, text: int = 1):
    """Record batches cut so that each slice holds at most ``max_bytes`` of the
    text column (or one document, if that alone is longer)."""
    import numpy as np
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        col = b.column(text)
        wide = pa.types.is_large_string(col.type)
        off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[
            col.offset:col.offset + n + 1].astype(np.int64)
        i = 0
        while i < n:
            j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
            j = min(n, max(j, i + 1))
            yield b.slice(i, j - i)
            i = j
