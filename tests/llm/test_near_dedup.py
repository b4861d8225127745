import random
from collections import defaultdict
from itertools import combinations

import numpy as np

from tidemark.llm import near_dedup as nd
from tests.llm.conftest import SCHEMA, hostile_rows


def sets(rows, size):
    out = defaultdict(list)
    for i, t, *_ in rows:
        words = (t or "").encode().lower().split()
        out[i].append({tuple(words[k: k + size]) for k in range(max(1, len(words) - size + 1))} if words else set())
    return out


def brute(rows, size, threshold=80):
    """Components by comparing every pair."""
    found = sets(rows, size)
    parent = {i: i for i in found if i is not None}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for (a, xs), (b, ys) in combinations([x for x in found.items() if x[0] is not None], 2):
        if any(x and y and 100 * len(x & y) >= threshold * len(x | y) for x in xs for y in ys):
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return {i: root(i) for i in parent}


def check(df, rows, size):
    want, own = brute(rows, size), sets(rows, size)
    got = nd.find_groups(df, size=size).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles in {len(s) for s in own[r.doc_id]}
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)


def test_hostile_rows_match_brute_force(hostile):
    check(hostile, hostile_rows(), 2)


def test_chains_and_large_groups_match_brute_force(spark):
    """Chains of edits, where the ends are unlike, and one group of near copies that all differ."""
    rng, rows = random.Random(5), []
    words = [f"w{k}" for k in range(400)]
    for _ in range(6):
        text = [rng.choice(words) for _ in range(80)]
        for _ in range(12):
            rows.append(" ".join(text))
            for _ in range(rng.randint(1, 6)):
                text[rng.randrange(len(text))] = rng.choice(words)
    base = [rng.choice(words) for _ in range(120)]
    rows += [" ".join(base[:k] + [f"own{k}"] + base[k + 1:]) for k in range(60)]
    rng.shuffle(rows)
    rows = [(k * 3 + 1, t, None, None, None, None, None, None) for k, t in enumerate(rows)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(4), rows, 2)


def test_stage_keeps_columns_and_one_of_each_group(hostile):
    left = nd.drop_near_copies(hostile, size=2)
    want = brute(hostile_rows(), 2)
    assert left.columns == hostile.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(r[0] for r in hostile_rows() if r[0] is not None and want[r[0]] == r[0])


def test_empty(nothing):
    assert nd.find_groups(nothing).collect() == [] and nd.drop_near_copies(nothing).collect() == []


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 90), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in nd.components(links).collect()}
    assert got == {k: 0 for k in range(61)} | {90: 90, 100: 90}


def test_signature_estimates_similarity():
    family = nd.hash_family(240)
    text = [f"w{k}" for k in range(400)]
    a, b = (nd.shingle_set(" ".join(t).encode(), 2) for t in (text, text[60:]))
    both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((nd.signature(a, family) == nd.signature(b, family)).mean() - both) < 0.1


def test_signature_check_misses_far_fewer_links_than_banding():
    from math import comb

    places, p = nd.BANDS * nd.ROWS, nd.THRESHOLD / 100
    least = (nd.THRESHOLD - nd._MARGIN) / 100
    missed = sum(comb(places, k) * p ** k * (1 - p) ** (places - k) for k in range(places + 1) if k / places < least)
    assert missed < (1 - p ** nd.ROWS) ** nd.BANDS / 1000
