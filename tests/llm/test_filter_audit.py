import re
from collections import Counter
from itertools import permutations

from tidemark.llm import filter_audit as fa
from tests.llm.conftest import hostile_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    """The audit by walking every order over every row."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = []
    for r in rows:
        text = r[1] or ""
        words = WORD.findall(text)
        smaller = any(o[0] is not None and r[0] is not None and o[0] < r[0] and (o[1] or "") == text for o in rows)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": smaller}
        docs.append((r[3] or "", r[0], fails))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        alive = docs
        for step, f in enumerate(order, 1):
            removed = [d for d in alive if d[2][f]]
            alive = [d for d in alive if not d[2][f]]
            for part in {d[0] for d in docs}:
                here = [d for d in removed if d[0] == part]
                all_fails = [d for d in docs if d[0] == part and d[2][f]]
                out[(part, order, step)] = (
                    sum(d[0] == part for d in alive), len(here), len(all_fails) - len(here),
                    sum(sum(d[2].values()) == 1 for d in all_fails), sum(d[1] in good for d in here), sum(d[1] in toxic for d in here))
                shapley[(part, f)] += len(here)
    return {k: v + (shapley[(k[0], k[1][k[2] - 1])],) for k, v in out.items()}


def audited(docs, labels):
    rows = fa.audit(docs, labels).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in rows}
    assert len(got) == len(rows)
    return got


def label_rows():
    return [(i, i % 2, int(i % 3 == 0)) for i in range(1, 40)] + [(2, 1, 1), (2, 0, None), (None, 1, 1), (3, None, 0)]


def test_audit_matches_walking_every_order(spark, hostile):
    shouting = [(100 + k, "LOUD words # here " * 20, "en", "s1", 1, "x", None, "r") for k in range(3)]
    docs = hostile.unionByName(spark.createDataFrame(shouting, hostile.schema))
    labels = spark.createDataFrame(label_rows(), "doc_id long, quality int, toxic int")
    assert audited(docs, labels) == brute(hostile_rows() + shouting, label_rows())


def test_hot_copies_take_both_ways(spark, monkeypatch):
    rows = [(k, "same text" if k % 3 else f"other {k // 6}", "en", "s", 1, "x", None, "r") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, row string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for share in (0.001, 0.5, 2.0):
        monkeypatch.setattr(fa, "HOT_SHARE", share)
        assert audited(docs, labels) == brute(rows, [])


def test_empty(spark, nothing):
    assert fa.audit(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


def test_failing_ids_are_one_table_per_filter(hostile):
    rows = fa.judge_rows(hostile)
    tables = fa.failing_ids(rows)
    assert list(tables) == list("ABCDE")
    for name in "ABCD":
        assert {r.row_id for r in tables[name].collect()} == {r.row_id for r in rows.where(name).collect()}
    plan = tables["B"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(filter" in plan
