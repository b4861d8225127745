from collections import Counter

import corpus_pipeline as cp
from tidemark.llm import exact_dedup, mixing, near_dedup, toxicity
from tests.llm.test_near_dedup import brute
from tests.llm.test_packing import whole_ids

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in cp.STAGES]
    assert names == ["toxicity", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    for name, stage in cp.STAGES:
        before = [tuple(r) for r in docs.collect()]
        after = stage(spark, docs, SF)
        rows = [tuple(r) for r in after.collect()]
        if name != "best-fit packing":
            assert after.columns == columns
            assert set(rows) <= set(before)
        if name == "exact dedup":
            largest = {}
            for r in before:
                largest[r[1]] = max(r[0], largest.get(r[1], r[0]))
            assert sorted(r[0] for r in rows) == sorted(largest.values())
        elif name == "MinHash near-dedup":
            want = brute([r[:2] for r in before], 5)
            assert sorted(r[0] for r in rows) == sorted({want[r[0]] for r in before})
        elif name == "mixing sources to target weights":
            assert max(Counter(rows).values()) <= 2 and len(rows) > len(before)
        elif name == "best-fit packing":
            assert sum(r[3] for r in rows) == sum(map(len, whole_ids([r[1] for r in before])))
        docs = spark.createDataFrame(rows, after.schema).repartition(3)


def test_run_gives_packed_pieces(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []
