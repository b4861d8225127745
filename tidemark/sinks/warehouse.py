"""Zone writes, warehouse append, table DDL, audit snapshots, exports.

SNK1-SNK14.  Layout (all under a root in the shared file system):

* ``{root}/landing/source=…/run_id=…``  original files and their manifest (SNK1, SNK13, see ``landing``)
* ``{root}/raw|prepared|curated/zone_source=…/zone_run=…``  zone rows (SNK2-SNK4)
* ``{root}/warehouse/curated_events/source_entity=…``  appended curated rows,
  sorted by ``(run_id, dw_id)`` inside each file so a run filter skips row
  groups by their min/max statistics (SNK6)
* ``{root}/audit/pipeline_runs``  run audit rows (SNK8, see ``run_audit``)

Zone writes overwrite only their own ``source/run_id`` partition (dynamic
partition overwrite), so reruns are idempotent and runs never clobber each
other; a lost executor just reruns its task.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import CURATED_COLUMNS, CURATED_SCHEMA
from tidemark.sinks.landing import land_files
from tidemark.sinks.run_audit import append_run, read_runs  # noqa: F401  (part of this module's interface)

ZONES = ("raw", "prepared", "curated")
#: Pieces that a run's rows of one map task are dealt into before they meet in files.
SPREAD = 32


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def written_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` (a file-system metadata call, no data read)."""
    fs, hpath = _jvm_fs(spark, path)
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def write_landing(spark: SparkSession, input_path: str, root: str, source: str, run_id: str) -> str:
    """SNK1/SNK13: the landed files as they are, byte for byte, with a manifest; a rerun replaces them."""
    path = f"{root}/landing/source={source}/run_id={run_id}"
    land_files(spark, input_path, path)
    return path


def write_zone(df: DataFrame, root: str, zone: str, source: str, run_id: str, fmt: str = "parquet") -> str:
    """SNK2-SNK4: rows of one run into ``{zone}/zone_source=…/zone_run=…``.

    The partition columns have their own names so they never collide with
    data columns (curated rows carry a ``run_id`` of their own).
    """
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}")
    out = df.withColumns({"zone_source": F.lit(source), "zone_run": F.lit(run_id)})
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("zone_source", "zone_run").format(fmt).save(f"{root}/{zone}"))
    return f"{root}/{zone}/zone_source={source}/zone_run={run_id}"


def read_zone(spark: SparkSession, root: str, zone: str, source: str, run_id: str,
              fmt: str = "parquet") -> DataFrame:
    """One run's rows back from a zone (partition pruning on source/run)."""
    df = spark.read.format(fmt).load(f"{root}/{zone}")
    return (df.where((F.col("zone_source") == source) & (F.col("zone_run") == run_id))
            .drop("zone_source", "zone_run"))


def curated_table_path(root: str) -> str:
    return f"{root}/warehouse/curated_events"


def create_curated_table(spark: SparkSession, root: str, name: str = "curated_events") -> None:
    """SNK7: ``CREATE TABLE IF NOT EXISTS`` over the warehouse folder.

    Partition folders written by path appends are registered with
    ``recoverPartitions`` (call it again after later appends when readers go
    through the catalog; ``read_curated`` reads by path and is always current).
    """
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CURATED_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY (source_entity) LOCATION '{curated_table_path(root)}'")
    spark.catalog.recoverPartitions(name)


def append_curated(curated: DataFrame, root: str, *, run_id: str | None = None) -> int:
    """SNK6: append the 11 columns; ISO text times become timestamps.

    Returns the number of rows written, counted by ``observe`` during the
    write itself (no second job over the data).  An empty batch writes nothing.

    With ``run_id`` the batch is that run's whole output: it is staged and published under the run's name, so a second try of
    the run takes the place of its first.  Without one every call adds its rows (SET2: bag union).
    """
    cols = []
    for f in CURATED_SCHEMA.fields:
        c = F.col(f.name)
        if f.name == "loaded_at" and dict(curated.dtypes).get("loaded_at") == "string":
            c = F.to_timestamp(F.replace(c, F.lit("Z"), F.lit("+00:00")))
        cols.append(c.cast(f.dataType).alias(f.name))
    obs = Observation("curated_append")
    out = curated.select(*cols).observe(obs, F.count(F.lit(1)).alias("rows"))
    # REBALANCE on (source, run, spread) gives files of the advisory partition size: small pieces are put together and a
    # hot source is split, not gathered in one task.  It splits between the pieces of map tasks only, so the spread keeps
    # a piece, and with it the rows that one task sorts, small however many rows of a run one map task reads.
    spread = F.pmod(F.xxhash64("dw_id"), F.lit(SPREAD))
    table = curated_table_path(root)
    target = table if run_id is None else f"{table}/_staging/{uuid.uuid4().hex}"  # readers skip the underscore
    (out.withColumn("_spread", spread).hint("rebalance", "source_entity", "run_id", "_spread")
     .sortWithinPartitions("source_entity", "run_id", "dw_id").drop("_spread")
     .write.mode("append").partitionBy("source_entity").parquet(target))
    if run_id is not None:
        _publish_run(curated.sparkSession, table, target, run_id)
    return int(obs.get.get("rows", 0))


def _publish_run(spark: SparkSession, table: str, staging: str, run_id: str) -> None:
    """Move a run's staged files into the table under its name, then remove what an earlier try left.

    File-system metadata only (a run has few files).  A try that ends half-way leaves files that the next one removes.
    """
    name, attempt = hashlib.sha256(run_id.encode()).hexdigest()[:16], uuid.uuid4().hex[:8]
    fs, place = _jvm_fs(spark, table)
    path = spark._jvm.org.apache.hadoop.fs.Path
    _forget_compacted(spark, table, run_id, name)
    earlier = [s.getPath() for s in fs.globStatus(path(place, f"source_entity=*/run-{name}-*"))]
    for number, status in enumerate(fs.globStatus(path(path(staging), "source_entity=*/*.parquet")) or []):
        file = status.getPath()
        folder = path(place, file.getParent().getName())
        fs.mkdirs(folder)
        if not fs.rename(file, path(folder, f"run-{name}-{attempt}-{number:05d}.parquet")):
            raise OSError(f"{file} could not be published in {folder}")
    for file in earlier:
        fs.delete(file, False)
    fs.delete(path(staging), True)


def _forget_compacted(spark: SparkSession, table: str, run_id: str, name: str) -> None:
    """Take a run out of files that hold several runs (after a compaction); rewrites only the sources that have it."""
    fs, place = _jvm_fs(spark, table)
    if not any(True for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, "source_entity=*"))):
        return
    rows = spark.read.option("mergeSchema", False).parquet(table)
    mixed = rows.where((F.col("run_id") == run_id) & ~F.col("_metadata.file_name").startswith(f"run-{name}-"))
    for (source,) in mixed.select("source_entity").distinct().collect():  # a run has one source
        _rewrite_source(spark, table, source, rows.where((F.col("source_entity") == source) & (F.col("run_id") != run_id)))


def compact_curated(spark: SparkSession, root: str, source_entity: str) -> None:
    """Rewrite one source's small files as few large ones, sorted by (run_id, dw_id).

    The new files are complete in a staging folder before they replace the old
    ones (dynamic overwrite of this partition only); run it while no append runs."""
    table = curated_table_path(root)
    _rewrite_source(spark, table, source_entity, spark.read.parquet(table).where(F.col("source_entity") == source_entity))


def _rewrite_source(spark: SparkSession, table: str, source_entity: str, rows: DataFrame) -> None:
    staging = f"{table}/_compact/{uuid.uuid4().hex}"
    rows.hint("rebalance").sortWithinPartitions("run_id", "dw_id").write.mode("overwrite").parquet(staging)
    staged = spark.read.parquet(staging)
    if staged.isEmpty():  # a dynamic overwrite would leave the partition as it is
        place = f"{table}/source_entity={source_entity}"
    else:
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_entity").parquet(table)
        place = staging
    for path in {place, staging}:
        fs, hpath = _jvm_fs(spark, path)
        fs.delete(hpath, True)


def read_curated(spark: SparkSession, root: str) -> DataFrame:
    """SRC15: the warehouse table, columns in contract order."""
    return spark.read.parquet(curated_table_path(root)).select(*CURATED_COLUMNS)


def write_mart(mart: DataFrame, root: str, name: str = "fct_source_metrics") -> str:
    """SNK12: the mart is a full rebuild (overwrite)."""
    path = f"{root}/marts/{name}"
    mart.write.mode("overwrite").parquet(path)
    return path


def register_view(df: DataFrame, name: str) -> None:
    """SNK11: staging model as a view."""
    df.createOrReplaceTempView(name)


# ---------------------------------------------------------------------------
# SNK10 / SNK14: JSON exports
# ---------------------------------------------------------------------------
def export_version(rows: DataFrame, path: str, header: dict) -> str:
    """SNK14: data rows as JSON Lines plus a one-row manifest with the header
    fields (run id, file id/name, record count, stage, version id, time)."""
    spark = rows.sparkSession
    obs = Observation("export")
    rows.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/data")
    manifest = dict(header, record_count=int(obs.get.get("n", 0)))
    spark.createDataFrame([(json.dumps(manifest, ensure_ascii=False),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return path


def write_report(checks: DataFrame, path: str) -> str:
    """SNK10: validation results as JSON."""
    checks.coalesce(1).write.mode("overwrite").json(path)
    return path
