"""Queries of the training-data operators: one ``opN_<name>`` each, over the whole table.

``ORACLES`` has the same rows as DuckDB SQL where SQL can express the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import conversation_trie, exact_dedup, filter_audit, language_model, mixing, near_dedup, packing, quality, retrieval_packing, token_files, topk_search, toxicity, url_filter
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return keep


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_minhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.find_groups(table(spark, sf_dir, "documents"), size=2)


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op4_maxent_language_model")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


@query("op5_quality_factorisation")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_exact_dedup", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
         g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t),
         m AS (SELECT doc_id, keep_id, group_size, t FROM d JOIN g USING (t))
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256,
           count(*) FILTER (WHERE doc_id = keep_id) OVER (PARTITION BY t) AS kept_rows
    FROM m
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


@query("op7_source_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents"))


@query("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"))
    return token_files.read_token_files(spark, manifest)


@query("op8_url_templates", url_filter.oracle_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op10_topk_search", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
               FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
         r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"))


@query("op11_conversation_trie", conversation_trie.oracle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.build(table(spark, sf_dir, "conversations"))


@query("op12_retrieval_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_packing.pack(table(spark, sf_dir, "documents"))


@query("op13_filter_audit", filter_audit.oracle_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
