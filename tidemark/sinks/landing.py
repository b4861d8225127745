"""Landing zone: files copied by tasks, byte for byte, with a manifest (SNK1, SNK13).

Spark lists the input with sizes (no contents), numbers the files by path and deals them out; a task streams each of its files in
blocks to a name of its own try and moves it into place whole, so a retried or doubled task leaves one whole file.
All of it happens in a folder beside the landing folder.  Only when the manifest (a row per file: number, path,
name, bytes, SHA-256) agrees with the listing, the folder takes the place of an earlier one of the same run.  No byte of a file and no
row per file passes through the driver.

Files without a byte hold no payload and are not landed.
Tasks open files by ``pyarrow.fs``: local and shared folders, HDFS, S3, GCS and Azure paths.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.files import file_opener

MANIFEST = "_manifest"  # Spark's readers skip names that start with an underscore
MANIFEST_SCHEMA = "number long, source string, name string, bytes long, sha256 string"
#: Bytes a copy task should get, as far as whole files allow.
TASK_BYTES = 512 * 1024 * 1024


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of all files below a path that Spark's readers would read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length"))


def _copy_files(folder: str, block: int):
    opened = file_opener()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import uuid

        target_fs, target = opened(folder)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                source_fs, source = opened(row["path"])
                name = f"{row['number']:06d}-{source.rsplit('/', 1)[-1]}"
                attempt, digest, size = f"{target}/_{uuid.uuid4().hex}", hashlib.sha256(), 0
                with source_fs.open_input_stream(source, compression=None) as src, target_fs.open_output_stream(attempt, compression=None) as dst:
                    while data := src.read(block):
                        dst.write(data)
                        digest.update(data)
                        size += len(data)
                target_fs.move(attempt, f"{target}/{name}")
                rows.append({"number": row["number"], "source": row["path"], "name": name, "bytes": size, "sha256": digest.hexdigest()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("number", pa.int64()), ("source", pa.string()), ("name", pa.string()),
                                                                     ("bytes", pa.int64()), ("sha256", pa.string())]))

    return run


def land_files(spark: SparkSession, input_path: str, target: str, *, block: int = 8 << 20) -> DataFrame:
    """Copy every file below ``input_path`` into ``target``; returns the manifest.  A rerun replaces what is there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(target)
    file_system = place.getFileSystem(conf)
    staging = f"{target.rstrip('/')}-{uuid.uuid4().hex}"
    staged = jvm.org.apache.hadoop.fs.Path(staging)
    file_system.mkdirs(staged)
    listed = list_files(spark, input_path)
    files, total = listed.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, min(files, max(2 * spark.sparkContext.defaultParallelism, total // TASK_BYTES)))
    numbered = listed.withColumn("number", F.row_number().over(Window.orderBy("path")).cast("long") - 1)  # one row per file
    copied = numbered.repartition(int(tasks)).mapInArrow(_copy_files(staging, block), MANIFEST_SCHEMA)
    copied.write.parquet(f"{staging}/{MANIFEST}")
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{staging}/{MANIFEST}")
    wrong = (manifest.join(listed, manifest["source"] == listed["path"], "full")
             .where("NOT (coalesce(bytes, -1) = coalesce(length, -2))").count())
    if wrong:
        file_system.delete(staged, True)
        raise OSError(f"{wrong} of {files} files changed while they were landed from {input_path}")
    file_system.delete(place, True)
    file_system.mkdirs(place.getParent())
    if not file_system.rename(staged, place):
        raise OSError(f"{staging} could not take the place of {target}")
    return read_manifest(spark, target)


def read_manifest(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{target}/{MANIFEST}")


def verify_landing(spark: SparkSession, target: str) -> DataFrame:
    """One row per file of the manifest or the folder: name, bytes, and whether the landed bytes are those of the manifest.

    Reads each file whole, so files beyond two gigabytes are checked by size alone.
    """
    landed = spark.read.format("binaryFile").load(target).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "length",
        F.when(F.col("length") < (1 << 31) - 1, F.sha2("content", 256)).alias("landed_sha256"))
    both = read_manifest(spark, target).join(landed, "name", "full")
    same = (F.col("bytes") == F.col("length")) & F.coalesce(F.col("sha256") == F.col("landed_sha256"), F.col("landed_sha256").isNull())
    return both.select("number", "name", "bytes", F.coalesce(same, F.lit(False)).alias("intact"))
