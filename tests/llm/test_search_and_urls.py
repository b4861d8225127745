import math

import duckdb
import pytest

from tidemark.llm import topk_search as ts
from tidemark.llm import url_filter as uf


def brute_search(rows, every, k):
    use = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in use:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in use if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_search_matches_brute_force(spark):
    import random

    rng = random.Random(2)
    rows = [(k, [rng.uniform(-1, 1) for _ in range(6)]) for k in range(130)]
    rows += [(200 + k, [0.5, 0.25, 0.0, 0.0, -0.5, 1.0]) for k in range(60)]  # many ties
    rows += [(500, None), (510, [1.0, None]), (520, [float("nan"), 1.0]), (530, [float("inf")]), (540, []), (550, [1.0, 2.0]), (None, [1.0]), (560, [0.0] * 9), (3, [0.1] * 6)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string").repartition(3)
    import numpy as np

    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for blocks in (ts.BLOCK_ROWS, 20):
        got = sorted(map(tuple, ts.search(df, every=10, block_rows=blocks, group_rows=7).collect()))
        assert got == brute_search(exact, 10, 5)


def test_search_of_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, ts.search(df).collect())) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    assert ts.search(df.limit(0)).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        ts.search(spark.createDataFrame([(0, [1e14]), (1, [1e14])], "vec_id long, embedding array<double>")).collect()
    for huge in (-1e30, 1e30, -4e16):  # beyond what floor can hold: no saturated score
        with pytest.raises(Exception, match="leave 64 bits"):
            ts.search(spark.createDataFrame([(0, [1.0, 1.0]), (1, [huge, 0.0]), (50, [1.0, 0.0])], "vec_id long, embedding array<double>")).collect()


def test_weights_beyond_32_bits_stay_exact(spark):
    rows = [(0, [9e6]), (1, [-9e6]), (2, [0.5]), (50, [8.5e6])]
    got = sorted(map(tuple, ts.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == brute_search(rows, 50, 5)


def test_rows_of_one_id_are_queries_and_candidates_one_by_one(spark):
    rows = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (50, [3.0, -1.0]), (50, [2.0, 1.0]), (7, [0.5, 0.5]), (7, [4.0, 0.0]), (9, [-1.0, 0.25]), (100, [0.0, 0.0])]
    weights = [[math.floor(256 * x) for x in v] for _, v in rows]
    expected = []
    for q, (query, _) in enumerate(rows):
        if query % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(weights[q], weights[c])), i) for c, (i, _) in enumerate(rows) if c != q)[:5]
            expected += [(query, n + 1, i, -score) for n, (score, i) in enumerate(scored)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for blocks in (ts.BLOCK_ROWS, 2):
        assert sorted(map(tuple, ts.search(df, block_rows=blocks, group_rows=2).collect())) == sorted(expected)


def test_scores_that_fit_are_exact_however_large_the_products(spark):
    def schema(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    near = [(0, [1e7, 1e7, 3.0]), (1, [1e7, -1e7, 2.0]), (2, [-3.0, 1e7, 1e7]), (50, [1.0, 1.0, 1.0]), (51, [1e7, 0.0, 0.0])]
    assert sorted(map(tuple, ts.search(schema(near)).collect())) == brute_search(near, 50, 5)
    low = [(0, [1e9])] + [(k, [float(k)]) for k in range(1, 8)] + [(9, [-1e9 * 40])]  # one score below 64 bits, not among the best
    for blocks in (ts.BLOCK_ROWS, 1):
        assert sorted(map(tuple, ts.search(schema(low), block_rows=blocks).collect())) == brute_search(low, 50, 5)
    with pytest.raises(Exception, match="leave 64 bits"):
        ts.search(schema(low[:1] + low[-1:])).collect()


URLS = [None, "no scheme", "http://A.Example.ORG", "http://a.example.org?x=/es/", "https://x.example.org/es/1", "https://example.org/en/1", "http://example.org/en/2/",
        "http://badexample.org/es/", "http://m.y.com/fr/a", "http://m.y.com/de/a#t", "ftp://com/de/", "http://u@h:80/p://q/r", "http://h.net/" + "/".join("abcdefghij"), "://", "http:///x", "a://b/ÄÖ?q"]


def pages_and_labels(spark):
    urls = URLS + [f"http://site.net/{'bad' if k % 3 == 0 else 'good'}/{k}.html" for k in range(90)] + [f"http://site.net/mixed/{k % 4}/{k}" for k in range(60)]
    pages = [(k, u, None, "v", "t") for k, u in enumerate(urls)] + [(3, urls[3], None, "v", "t"), (None, "http://site.net/bad/x", None, None, None)]
    labels = [(k, None if k % 11 == 0 else int("bad" not in (u or "")), 0) for k, u in enumerate(urls) if k % 2] + [(None, 1, 0), (5, 0, 0)]
    return (spark.createDataFrame(pages, "page_id long, url string, html string, verdict string, template string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_url_filter_matches_sql(spark):
    pages, labels = pages_and_labels(spark)
    con = duckdb.connect()
    for name, df in (("pages", pages), ("labels", labels)):
        con.register(f"{name}_", df.toArrow())
        con.sql(f"CREATE TABLE {name} AS SELECT * FROM {name}_")
    key = lambda r: tuple(map(str, r))
    got = uf.filter_pages(pages, labels).select("page_id", "host", "path", "rule", "verdict", "template").collect()
    assert sorted(map(key, got)) == sorted(map(key, con.sql(uf.oracle_sql()).fetchall()))
    verdict = {r.page_id: (r.rule, r.verdict) for r in got}
    assert verdict[2] == (None, "allow") and verdict[4] == ("example.org/es/", "block") and verdict[5] == ("example.org/en/1", "block")
    assert verdict[6] == ("org/", "allow") and verdict[7] == ("org/", "allow") and verdict[8] == ("com/fr/", "allow") and verdict[10] == ("com/de/", "block")
    bad = {r.verdict for r in got if r.template == "/bad/*"}
    good = {r.verdict for r in got if r.template == "/good/*"}
    assert (bad, good) == ({"block"}, {"allow"})


def test_url_filter_empty_and_native(spark):
    pages, labels = pages_and_labels(spark)
    assert uf.filter_pages(pages.limit(0), labels).collect() == []
    assert {r.verdict for r in uf.filter_pages(pages.where("url is null"), labels.limit(0)).collect()} == {"allow"}
    plan = uf.filter_pages(pages, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_url_filter_tells_small_sections_and_deep_ones_apart(spark):
    urls = [f"http://big.net/s{k % 150}/{k}" for k in range(3000)]  # 0.67% of the rows a section
    urls += [f"http://deep.net/a/b/c/d/e/f/{s}/{k}" for s in ("spam", "news") for k in range(30)]
    urls += [f"http://deep.net/a/b/c/d/e/f/{k}/{s}/x{k}" for s in ("bad", "good") for k in range(100, 130)]
    bad = lambda u: "/s7/" in u or "/spam/" in u or "/bad/" in u
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(k, int(not bad(u)), 0) for k, u in enumerate(urls)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in uf.filter_pages(pages, labels).collect()}
    assert len(got) == len(urls)
    assert [k for k, u in enumerate(urls) if (got[k].verdict == "block") != bad(u)] == []
    assert {got[k].template for k in range(3000, 3120)} == {"/a/b/c/d/e/f/spam/**", "/a/b/c/d/e/f/news/**", "/a/b/c/d/e/f/*/bad/**", "/a/b/c/d/e/f/*/good/**"}
