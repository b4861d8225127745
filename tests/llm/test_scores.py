import random
import zlib
from collections import Counter
from math import log10
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_model as lm
from tidemark.llm import quality, toxicity
from tidemark.session import shared_path
from tests.llm.conftest import WORDS, hostile_rows


def labelled(spark, label):
    """Documents whose label is decided by words (toxic) or structure (quality)."""
    rng, docs, labels = random.Random(9), [], []
    for k in range(1200):
        words = [rng.choice(WORDS) + rng.choice(["", "en", "o"]) for _ in range(rng.randint(5, 60))]
        y = int(rng.random() < 0.25)
        if y and label == "toxic":
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(["grobnax", "grobnaxes", "vilmar", "moron"])
        text = " ".join(words)
        if y and label == "quality":
            text = " ".join(w.upper() + "!!" for w in words)
        docs.append((k, text, "en", "s", len(text)))
        if k % 5:
            labels.append((k, 1 - y if label == "quality" else 0, y if label == "toxic" else 0))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, module, label):
    docs, labels = labelled(spark, label)
    got = module.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= module.THRESHOLD)).all()
    held = got[got.held_out]
    assert len(held) > 150 and (held.predicted == held[label]).mean() > 0.95


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_hostile_rows_and_no_labels(spark, hostile, nothing, module, label):
    docs, labels = labelled(spark, label)
    none = labels.limit(0)
    assert {r.score for r in module.score_documents(hostile, none).collect()} == {0.5}
    assert module.score_documents(nothing, labels).collect() == []
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (1, None, None), (8, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int"))
    both = docs.select("doc_id", "text", "n_chars").union(hostile.select((F.col("doc_id") + 5000).alias("doc_id"), "text", "n_chars"))
    got = module.score_documents(both, odd).collect()
    assert len(got) == both.count() and all(0 <= r.score <= 1 for r in got)


def test_drop_toxic_keeps_columns(spark):
    docs, labels = labelled(spark, "toxic")
    docs = docs.withColumn("row", F.lit(1)).withColumn("score", F.lit("s")).withColumn("features", F.lit(None).cast("int"))
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in left.select("doc_id").collect()}
    wrong = {r.doc_id for r in labels.where("toxic = 0").collect()} & gone
    assert gone and len(wrong) < 10


def test_factorisation_identity_and_gradient():
    rng = np.random.default_rng(0)
    machine = quality.Machine(0.3, rng.normal(size=quality.SIZE).astype(np.float32), rng.normal(size=(quality.SIZE, 8)).astype(np.float32))
    rows = [(np.array([3, 9, 11]), np.array([0.5, -1.0, 2.0], np.float32)), (np.array([9]), np.array([1.5], np.float32))]
    margin, _ = machine.margin(*quality._run(rows))
    for m, (p, v) in zip(margin, rows):
        pairs = sum(machine.factors[p[i]] @ machine.factors[p[j]] * v[i] * v[j] for i in range(len(p)) for j in range(i))
        assert m == pytest.approx(0.3 + machine.linear[p] @ v + pairs, abs=1e-3)


def test_language_model_counts_match_brute_force(hostile):
    rows = hostile_rows()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows if i is not None} | {None: False}
    words = lambda t: (t or "").encode().lower().split() + ["end"]
    counts = Counter(w for i, t, *_ in rows if not held[i] for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((i or -1, held[i], len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                   round(sum(log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 5)) for i, t, *_ in rows)
    for known in (lm.HEAD + 5, lm.KNOWN):
        got = lm.score_documents(hostile, known=known).collect()
        assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
        assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_language_model_is_a_distribution_and_learns(spark):
    rng, docs = random.Random(4), []
    for k in range(600):
        text = []
        for _ in range(30):
            text += ["red", rng.choice(["apple", "rose"])] if rng.random() < 0.5 else ["blue", rng.choice(["sky", "sea"])]
        docs.append((k, " ".join(text)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = lm.score_documents(df).toPandas()
    held = got[got.held_out]
    # two even choices for each pair of words, against four words' frequencies
    assert held.score.sum() / held.n_tokens.sum() > -0.36 and held.base_score.sum() / held.n_tokens.sum() < -0.6
    statistics = lm.gather(df)
    model = lm.fit(df, statistics, rounds=2)
    ids = np.array([lm._RARE, lm._END, *statistics.ids().values()])
    for h in (lm._START * lm._WIDTH + lm._START, 2 * lm._WIDTH + 3):
        assert (10 ** model.log10(np.full(len(ids), h), ids)).sum() == pytest.approx(1, abs=1e-5)


def test_language_model_empty(spark, nothing):
    assert lm.score_documents(nothing).collect() == []
    only_held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = lm.score_documents(spark.createDataFrame([(only_held, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_language_model_squares_of_frequent_features_are_not_clipped():
    tree = lm.Tree(0, np.zeros((1 + lm.CLASSES, lm._WIDE), np.float32), np.zeros(1))
    history, token, n = np.array([5]), np.array([2]), np.array([1_000_000])
    event, node, digit = lm.token_paths(token, 0)
    rows = [(k, d) for keys in lm.feature_keys(history[event], node) for k, d in zip(keys.tolist(), digit.tolist())]
    weights = pa.table({"key": [k for k, _ in rows], "digit": pa.array([d for _, d in rows], pa.int8()),
                        "weight": pa.array([0.0] * len(rows), pa.float32()), "square": pa.array([0.1] * len(rows), pa.float32())})
    got = lm._trainer(_Given(tree))(pa.table({"history": history, "token": token, "n": n}), weights)
    assert min(got.column("more").to_pylist()) > 1e11


class _Given:
    def __init__(self, value):
        self.value = value


def test_language_model_rows_grow_with_the_features_and_all_words_are_conditioned(spark):
    """More features than the former tables had rows; rare words as history and as outcome."""
    rng, docs = random.Random(8), []
    for k in range(1500):
        pairs = [rng.randrange(3000) for _ in range(15)]
        docs.append((k, " ".join(f"a{p} b{p}" for p in pairs)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    statistics = lm.gather(df)
    model = lm.fit(df, statistics, rounds=2)
    assert statistics.levels == 2 and statistics.leaf_types.sum() == statistics.types - lm.HEAD
    assert model.weights.count() == model.weights.select("key", "digit").distinct().count() > 16_384 + 32_768
    head, counted = set(statistics.ids()), {r.token for r in statistics.counts.collect()}
    rare = [k for k in range(2999) if {b"a%d" % k, b"b%d" % k} <= counted - head][:40]
    right, wrong = [], []
    for k in rare:
        a, b = (lm.contexts([f"{c}{k}".encode()]) for c in "ab")
        other = lm.contexts([f"b{k + 1}".encode()])
        history = np.concatenate([a, a]) + lm._WIDTH * 7
        token = lm._TAIL + lm.leaves(np.concatenate([b, other]), statistics.levels)
        x, y = model.log10(history, token) if token[0] != token[1] else (1, 0)
        right.append(x)
        wrong.append(y)
    assert len(rare) == 40 and np.mean(np.array(right) > np.array(wrong)) > 0.9
    every = np.concatenate([[lm._END], list(statistics.ids().values()), lm._TAIL + np.arange(lm._FAN ** statistics.levels)])
    p = 10 ** (model.log10(np.full(len(every), history[0]), every) + np.concatenate([np.zeros(lm.HEAD), model.tree.leaf_log]))
    assert p.sum() == pytest.approx(1, abs=1e-5)


def test_language_model_takes_the_same_passes_at_every_size(monkeypatch):
    tree = lm.Tree(0, np.zeros((1 + lm.CLASSES, lm._WIDE), np.float32), np.zeros(1))
    history, token, n = np.arange(100), np.full(100, 2), np.full(100, 3)
    event, node, digit = lm.token_paths(token, 0)
    table = pa.table({"key": np.concatenate(lm.feature_keys(history[event], node)), "digit": np.tile(digit, 3).astype(np.int8)})
    table = table.group_by(["key", "digit"]).aggregate([])
    table = table.append_column("weight", pa.array(np.zeros(len(table), np.float32))).append_column("square", pa.array(np.full(len(table), 0.1, np.float32)))
    touched = []
    for size in (1000, 20, 3):
        monkeypatch.setattr(lm, "_STEP_ROWS", size)
        rows = lm._Rows(table)
        lm._train(tree, rows, history, token, n)
        touched.append(rows.touched)
    assert (touched[0] == touched[1]).all() and (touched[0] == touched[2]).all()


def test_language_model_keeps_no_table_that_is_read_no_more(spark):
    labels = ("histories", "features", "touched", "weights", "events")
    folders = [Path(urlparse(shared_path(spark, "llm", label, unique=False)).path) for label in labels]
    had = {p for folder in folders for p in folder.glob("*")}
    docs = spark.createDataFrame([(k, f"a{k % 3} b c{k}") for k in range(30)], "doc_id long, text string")
    rows = lm.score_documents(docs).collect()
    assert len(rows) == 30 and all(r.score < 0 for r in rows)
    assert {p for folder in folders for p in folder.glob("*")} == had
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_language_model_features_are_made_in_their_parts(spark, capsys):
    rng = np.random.default_rng(5)
    history, token = rng.integers(0, 40, 900) * lm._WIDTH + rng.integers(0, 9, 900), rng.choice([1, 2, 40, lm._TAIL + 3, lm._TAIL + 900], 900)
    events = spark.createDataFrame(pa.table({"history": history, "token": token, "n": np.ones(900, np.int64)})).distinct()
    dealt = (events.withColumn("part", F.expr("CAST(pmod(xxhash64(history), 7) AS INT)")), 3)
    features = lm.features_by_part(dealt, 2)
    rows = features.collect()
    want = set()
    for r in dealt[0].collect():
        event, node, digit = lm.token_paths(np.array([r.token]), 2)
        want |= {(r.part, k, d) for keys in lm.feature_keys(np.array([r.history])[event], node) for k, d in zip(keys.tolist(), digit.tolist())}
    assert len(rows) == len(want) and {(r.part, r.key, r.digit) for r in rows} == want
    lead = [(r.part, r.key) for r in rows if r.lead]
    assert len(lead) == len(set(lead)) and set(lead) == {(p, k) for p, k, _ in want}
    stored = spark.createDataFrame(dealt[0].toArrow())
    lm.features_by_part((stored, 3), 2).where("lead").select("part", "key").explain()
    assert capsys.readouterr().out.count("Exchange") == 1  # the events', none of the features
