"""Registered queries at the smallest size: the contract's columns, one row per row, and SQL where there is one."""

import duckdb
import pytest

from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": "doc_id held_out score predicted", "op2_": "doc_id n_shingles component_id kept",
    "op3_": "doc_id piece start length ids_crc32 sequence_id offset", "op4_": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_": "doc_id held_out score predicted", "op6_": "doc_id keep_id group_size kept text_sha256",
    "op7_": "doc_id size source_size target taken", "op8_": "page_id host path rule verdict",
    "op9_": "doc_id start n_tokens ids_crc32", "op10_": "query_id rank vec_id score",
    "op11_": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op13_": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    got = QUERIES[name](spark, SF)
    contract = COLUMNS[name[: name.index("_") + 1]].split()
    assert got.columns[: len(contract)] == contract
    columns = sorted(got.columns)
    rows = sorted(map(repr, map(tuple, got.select(*columns).collect())))
    if name not in ORACLES:
        assert len(rows) >= 50
        return
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    assert rows == sorted(map(repr, want.select(*columns).fetchall()))
