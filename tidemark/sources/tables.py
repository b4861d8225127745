"""Parquet table scans of the driver-provided data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_SCANS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into the scan.

    The scan DataFrame is reused per session and path: a DataFrame is an
    immutable plan, and re-creating it would re-read the Parquet footers (a
    schema-inference job per call) every time a query mentions the table.
    """
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)   # the cached DataFrame keeps its session alive, so ids stay unique
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]
