from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as mx
from tests.llm.conftest import hostile_rows


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshare the excess by weight until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_targets_and_takes(hostile):
    rows = hostile_rows()
    size = {k: len((r[1] or "").encode().split()) for k, r in enumerate(rows)}
    sizes = defaultdict(int)
    for k, r in enumerate(rows):
        sizes[r[3]] += size[k]
    want = brute_targets(dict(sizes))
    got = mx.plan_mix(hostile, block_words=50).collect()
    again = mx.plan_mix(hostile.repartition(5), block_words=50).collect()
    key = lambda r: (r.doc_id or -1, r.size, r.target, r.taken, r.shards)
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], size[k]) for k, r in enumerate(rows))
    by_target = defaultdict(int)
    for r in got:
        assert r.taken <= 2 * r.size and r.taken == r.size * len(r.shards)
        by_target[(r.source_size, r.target)] += r.taken
    assert sorted(s for s, _ in by_target) == sorted(sizes.values())
    for (total, target), taken in by_target.items():
        assert any(sizes[s] == total and target == pytest.approx(t) for s, t in want.items())
        assert abs(taken - target) <= max(r.size for r in got if r.source_size == total)


def test_rows_follow_the_plan(hostile):
    plan = Counter()
    for r in mx.plan_mix(hostile).collect():
        plan[(r.doc_id, r.size)] += len(r.shards)
    mixed = mx.mix_rows(hostile)
    assert mixed.columns == hostile.columns
    assert Counter((r.doc_id, len((r.text or "").encode().split())) for r in mixed.collect()) == Counter({k: n for k, n in plan.items() if n})


def test_empty(nothing):
    assert mx.plan_mix(nothing).collect() == [] and mx.mix_rows(nothing).collect() == []


def test_split_deals_every_unit_once(spark):
    quotas = spark.createDataFrame([(0, 1000), (1, 3), (2, 0), (3, 517)], "number int, units long")
    rows = mx.split_quotas(quotas, levels=3).collect()
    assert len({r.shard for r in rows}) == 8
    for number, units in ((0, 1000), (1, 3), (2, 0), (3, 517)):
        own = sorted((r.shard, r.first, r.units) for r in rows if r.number == number)
        at = 0
        for _, first, n in own:
            assert n >= 0 and first == at
            at += n
        assert at == units
    totals = defaultdict(int)
    for r in rows:
        totals[r.shard] += r.units
    assert max(totals.values()) - min(totals.values()) <= 1


def test_draws_follow_the_hypergeometric_distribution(spark):
    pool, own, want = 40, 15, 12
    u = "((id + 0.5D) / 20000)"
    drawn = spark.range(20_000).select(F.expr(mx._draw(f"{pool}L", f"{own}L", f"{want}L", u)).alias("x"))
    seen = {r.x: r["count"] for r in drawn.groupBy("x").count().collect()}
    from math import comb

    for x in range(0, 13):
        p = comb(own, x) * comb(pool - own, want - x) / comb(pool, want)
        assert abs(seen.get(x, 0) / 20_000 - p) < 2e-4
    for pool, own, want, x in ((10, 10, 4, 4), (10, 0, 4, 0), (5, 3, 5, 3), (0, 0, 0, 0), (7, 3, 0, 0)):
        assert spark.range(1).select(F.expr(mx._draw(f"{pool}L", f"{own}L", f"{want}L", "0.7D")).alias("x")).first().x == x


def test_main_path_is_native(hostile):
    plan = mx.plan_mix(hostile)._jdf.queryExecution().toString() + mx.mix_rows(hostile)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_last_pass_goes_on_to_later_blocks_for_documents_that_fit(spark):
    sizes = {(s, k): 400 if k % 20 == 7 else 2 + k % 3 for s in range(3) for k in range(120)}
    docs = spark.createDataFrame([(1000 * s + k, "w " * n, f"s{s}") for (s, k), n in sizes.items()], "doc_id long, text string, source string")
    rows = mx.plan_mix(docs, weights=(3, 1, 2), share=1.1, most=2, block_words=60).collect()
    for s in range(3):
        own = [r for r in rows if r.doc_id // 1000 == s]
        passes = int(own[0].target) // own[0].source_size
        room = round(own[0].target) - sum(r.taken for r in own)
        assert 0 <= room < min(r.size for r in own if len(r.shards) == passes)
