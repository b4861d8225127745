"""Spark session construction and shared scratch locations.

Staging data (landed payloads, zone files, stream checkpoints) always goes to
the shared folder named by ``spark.checkpoint.dir``: on a cluster that is a
distributed file system every executor can reach.  A local folder is only
chosen when the session has no such setting and runs in one process
(``local[*]``), as in tests; on a cluster the setting is required.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; every value can be overridden by the caller.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Sorted writes for the warehouse layout; keeps files big and few.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; a private one only for a local master without the setting."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the context
        sc = None
    if current:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir() if sc is not None else None
    if existing:
        return existing
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    if sc is not None:
        sc.setCheckpointDir(local)
    return local


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint folder.

    Every call with ``unique=True`` gets its own folder, so concurrent runs and
    retried jobs never overwrite what another reader is still using.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    pieces = [_session_folder(spark, base.rstrip("/")), *parts]
    if unique:
        pieces.append(uuid.uuid4().hex)
    return "/".join(pieces)


_session_folders: dict[tuple[str, str], str] = {}


def _session_folder(spark: SparkSession, base: str) -> str:
    """One scratch folder per application and base; the driver removes it when it ends."""
    key = (spark.sparkContext.applicationId, base)
    if key not in _session_folders:
        _session_folders[key] = f"{base}/tidemark/{key[0]}-{uuid.uuid4().hex[:8]}"
        atexit.register(remove_path, spark, _session_folders[key])
    return _session_folders[key]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the session's file systems; nothing happens when the session has ended."""
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    try:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM has gone at interpreter exit
        pass


def stored(df, label: str):
    """An intermediate table written once under the shared checkpoint folder and read back as files."""
    path = shared_path(df.sparkSession, "staging", label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df):
    """Cut the lineage of an intermediate result used several times: a
    reliable checkpoint in the shared checkpoint folder (never a local one),
    so later uses read files instead of recomputing, and a lost executor does
    not recompute the whole chain."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
