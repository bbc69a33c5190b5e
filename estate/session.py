"""Session settings and the shared folder used for staging and checkpoints.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``
(set by whoever runs the cluster).  We read it from the session and only
create a folder of our own when it is unset, which happens in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings of the sessions estate builds itself.  Nothing in the library
# depends on them for correctness (timestamps are zone-free, writes pass their
# overwrite mode as an option), so sessions handed in by a caller are left as
# they are.
SQL_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "estate", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings estate relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # checkpoints of materialized join sides are dropped once unused
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_CONFS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_confs(spark)
    return spark


def apply_confs(spark: SparkSession) -> None:
    """Apply :data:`SQL_CONFS` to a session estate built."""
    for key, value in SQL_CONFS.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Return a path under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or the context's checkpoint
    dir).  Only when neither is set - local tests - is a fresh folder created
    and registered as the checkpoint dir, so that ``checkpoint()`` works too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:        # Spark Connect client: no context; the conf must name the folder
        sc = None
    if sc is not None:
        root = root or sc.getCheckpointDir()
    if not root:
        # Local runs only: executors of a cluster would not share this folder.
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="estate-ckpt-", dir="/tmp")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return os.path.join(root, *parts) if parts else root


def fresh_root(spark: SparkSession, label: str) -> str:
    """A new, unique staging root under the shared folder (one per run)."""
    import uuid
    return shared_dir(spark, "estate-runs", f"{label}-{uuid.uuid4().hex[:12]}")
