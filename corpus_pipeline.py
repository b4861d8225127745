"""The training-data pipeline: toxic documents out, copies out, near copies out, sources mixed, sequences packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``.  All stages but the last return the columns of ``documents``.

Rows go as follows: toxicity drops rows predicted toxic; exact dedup leaves the row with the largest doc_id of
equal texts; near dedup leaves the smallest doc_id of each group at 80 % of five-word shingles; mixing returns
a row as often as the mix takes it (not at all, once or twice); packing returns one row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from tidemark.llm.common import save, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL has no trained trees, so tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
