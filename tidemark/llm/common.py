"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove_path, shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the running tasks only, never the
    stages before this table.
    """
    return save_for_now(df, label)[0]


def save_for_now(df: DataFrame, label: str) -> tuple[DataFrame, Callable[[], None]]:
    """``save``, and a function that removes the table once nothing reads it any more."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), lambda: remove_path(spark, path)


_SHORT_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession):
    """Shuffle files of the queries run inside go when their query ends, not when the driver next collects garbage."""
    was = spark.conf.get(_SHORT_SHUFFLES)
    spark.conf.set(_SHORT_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHORT_SHUFFLES, was)


_shipped: set[str] = set()
_BATCH, _BATCH_DEFAULT, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Executors of a cluster, and a driver that only extended its own module
    path, need not have it installed.  Unless the session says otherwise, a worker
    gets about 4 MB at a time, not 64: each holds a batch twice, and its task too.
    """
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, str(_BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-zip-"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    spark.sparkContext.addPyFile(target)  # the driver serves it; nothing reads the local path
    _shipped.add(app)


@contextmanager
def shared(spark: SparkSession, value):
    """A broadcast of bounded size for the jobs run inside, removed from all executors afterwards."""
    broadcast = spark.sparkContext.broadcast(value)
    try:
        yield broadcast
    finally:
        broadcast.destroy()


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package available to the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def held_out(doc_id: Column, modulus: int) -> Column:
    """True where crc32(doc_id as text) mod ``modulus`` is 2; a null id counts as training data."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 2, F.lit(False))


def word_count(text: Column) -> Column:
    """Number of runs ``[^\\x20\\x09-\\x0D]+``; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", rows: int = 256,
           limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds few rows and few text bytes.

    Bounds a Python worker's memory: an incoming batch may hold ten thousand
    texts.  A single text over the limit forms a slice of its own.
    """
    for batch in batches:
        sizes = batch.column(text).cast(pa.binary())
        start, held = 0, 0
        for i in range(batch.num_rows):
            value = sizes[i]
            size = value.as_buffer().size if value.is_valid else 0
            if i > start and (i - start >= rows or held + size > limit):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def lower_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text with A-Z lower-cased.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at exactly these
    six ASCII white-space bytes, so no regular expression is needed.
    """
    return text.lower().split() if text else []
