import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import prepare as prep
from tidemark.operators.modes import cell_counts, certified_modes, summaries


def frame(spark, n=4_000):
    rng = random.Random(4)
    rows = [(k, "hot" if k % 3 == 0 else f"v{k}", f"id{k}", rng.choice("abcdefghijkl"), None if k % 2 else " ", f"t{k % 700}",
             "" if k % 5 else "tie" + str(k % 2)) for k in range(n)]
    return spark.createDataFrame(rows, "id long, skew string, unique string, few string, blank string, flat string, tie string").repartition(6)


def brute(df, names):
    out = {}
    for name in names:
        counts = {}
        for (v,) in df.select(name).collect():
            if v is not None and v.strip():
                counts[v] = counts.get(v, 0) + 1
        if counts:
            out[name] = min((-n, v) for v, n in counts.items())
    return {k: (v, -n) for k, (n, v) in out.items()}


@pytest.mark.parametrize("tracked, sure", [(10_000, {"skew", "few", "tie"}), (300, {"skew", "few", "tie"}), (16, set())])
def test_certified_modes_are_exact_at_any_summary_size(spark, tracked, sure):
    df = frame(spark)
    names = ["skew", "unique", "few", "blank", "flat", "tie"]
    rows = certified_modes(df, {n: F.col(n) for n in names}, tracked=tracked).collect()
    assert {r["column"]: (r["value"], r["n"]) for r in rows} == brute(df, names)
    certain = {r["column"] for r in rows if r["certified"]}
    assert sure <= certain | ({"few"} if tracked == 300 else set()) and "unique" not in certain


def test_ties_inside_the_candidates_go_to_the_smallest_text(spark):
    df = spark.createDataFrame([(v,) for v in "bbaacc" * 50 + "d"], "v string")
    assert [tuple(r) for r in certified_modes(df, {"v": F.col("v")}).collect()] == [("v", "a", 100, True)]


def test_many_equal_values_beyond_the_candidates_are_counted_in_full(spark):
    """More tied values than candidates: the last estimate bounds the others at the same count, so nothing is certified."""
    df = spark.createDataFrame([(f"{v:03d}",) for v in range(40) for _ in range(25)], "v string")
    assert [tuple(r) for r in certified_modes(df, {"v": F.col("v")}).collect()] == [("v", "000", 25, False)]


def test_bounds_hold_for_values_that_are_no_candidates(spark):
    df = frame(spark)
    names = ["skew", "unique", "few", "flat"]
    texts = {n: F.col(n) for n in names}
    for tracked in (16, 64, 1_000):
        found = {r["column"]: (set(r["hashes"]), r["bound"]) for r in summaries(df, texts, tracked=tracked).collect()}
        for r in cell_counts(df, texts).withColumn("h", F.xxhash64("value")).collect():
            hashes, bound = found[r["column"]]
            assert r["h"] in hashes or r["n"] <= bound


def test_defaults_are_the_same_both_ways(spark):
    df = frame(spark).withColumns({"items": F.array(F.col("few")), "when": F.to_date(F.lit("2024-01-01")), "none": F.lit(None).cast("string")})
    counted, certified = (prep.column_defaults(df, certified=c)[1].collect() for c in (False, True))
    assert counted == certified
