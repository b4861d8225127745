"""Quality scores by a factorisation machine.

Features of a whole text: hashed words with damped, normalised counts; structure statistics, each as the one
active of ``BINS`` ranges; and metadata (the declared number of characters against the text's own).  The score is

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

through the logistic function: the identity makes all pairwise interactions linear in the number of features.

Fitting takes at most ``MAX_ROWS`` labelled rows (those with the smallest hash of their id) as a written table of sparse
rows.  In each of ``ROUNDS`` rounds every partition of that table improves the
current parameters by Adagrad steps over its own rows, and the results are averaged.  The parameters have a
fixed size.  Scoring covers every row.

Edge cases: null or empty text has no word and the statistics of an empty text, and is scored; a null n_chars (or none such column) counts as the
text's own length; rows that repeat a doc_id are scored one by one; null labels or ids teach nothing; without labelled rows of both classes
every score is the smoothed share of label 1; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, lower_words, map_batches, save, slices
from tidemark.llm.toxicity import training_rows

MAX_ROWS = 20_000
MODULUS = 4
THRESHOLD = 0.7
WORDS = 1 << 14
FACTORS = 8
ROUNDS = 8
PARTITIONS = 8
BATCH = 64
RATE, DECAY = 0.1, 1e-5

STATISTICS = ("capitals", "shouted", "punctuation", "symbols", "bars", "digits", "spaces", "lines", "short_lines", "repeated_lines",
              "distinct", "top_word", "same_as_before", "same_two_before", "marked_words", "exclaimed", "word_length", "long_words",
              "sentences", "worst_capitals", "worst_symbols", "worst_repeats", "log_words", "declared_length")
EDGES = np.array([0.0005, 0.002, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9, 0.98])
BINS = len(EDGES) + 1
SIZE = WORDS + len(STATISTICS) * BINS

_SHOUT = re.compile(rb"\b[A-Z]{2,}\b")
_WINDOW = 40


def statistics(raw: bytes, words: list[bytes], declared: int | None) -> np.ndarray:
    """Shares in 0..1 that describe the structure of a text."""
    out = np.zeros(len(STATISTICS))
    out[-1] = 0.5 if declared is None else min(1.0, declared / (2 * max(1, len(raw.decode(errors="replace")))))
    if not raw:
        return out
    array = np.frombuffer(raw, np.uint8)
    count = np.bincount(array, minlength=128)
    size, n = len(raw), max(1, len(words))
    letters = max(1, count[65:91].sum() + count[97:123].sum() + count[128:].sum())
    symbols = count[35:39].sum() + count[42] + count[43] + count[60:63].sum() + count[64] + count[94] + count[124] + count[126]
    lines = raw.split(b"\n")
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    _, each = np.unique(codes, return_counts=True)
    before = codes[1:] == codes[:-1]
    marked = np.fromiter((w[-1] < 65 and w[-1] not in b".,;:?!'\")0123456789-" for w in words), bool, len(words))
    upper = (array >= 65) & (array <= 90)
    odd = np.isin(array, np.frombuffer(b"#$%&*+<=>@^|~!", np.uint8))
    step = 240
    at = np.arange(0, size, step)
    spans = np.diff(np.append(at, size))
    windows = np.add.reduceat(before, np.arange(0, len(before), _WINDOW)) / _WINDOW if len(before) else np.zeros(1)
    out[:-1] = (
        count[65:91].sum() / letters, len(_SHOUT.findall(raw)) / n, count[[33, 44, 46, 58, 59, 63]].sum() / size, symbols / size, count[124] / n,
        count[48:58].sum() / size, count[32] / size, len(lines) / (n + len(lines)), sum(len(x) < 20 for x in lines) / len(lines),
        1 - len(set(lines)) / len(lines), len(each) / n, each.max(initial=0) / n, before.sum() / n,
        (codes[2:] == codes[:-2]).sum() / n, marked.sum() / n, (count[33] + count[63]) / n, min(1.0, size / n / 20),
        sum(len(w) > 20 for w in words) / n, (count[46] + count[33] + count[63]) / n,
        (np.add.reduceat(upper, at) / spans).max(), (np.add.reduceat(odd, at) / spans).max(), windows.max(), min(1.0, np.log1p(len(words)) / 12))
    return out


def features(text: bytes | None, declared: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the features of one text."""
    import xxhash

    raw = text or b""
    words = lower_words(raw)
    marks = np.searchsorted(EDGES, statistics(raw, raw.split(), declared), side="right")
    places = WORDS + np.arange(len(STATISTICS)) * BINS + marks
    if not words:
        return places.astype(np.int32), np.ones(len(places), np.float32)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    hashed, each = np.unique((codes >> np.uint64(50)).astype(np.int32), return_counts=True)
    values = np.log1p(each)
    values /= np.sqrt((values ** 2).sum())
    return np.concatenate((hashed, places)).astype(np.int32), np.concatenate((values, np.ones(len(places)))).astype(np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, places: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margins and factor sums of rows given as one run of features cut at ``starts``; no row is empty."""
        scaled = self.factors[places] * values[:, None]
        sums = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat((scaled ** 2).sum(axis=1), starts)
        return self.bias + np.add.reduceat(self.linear[places] * values, starts) + 0.5 * ((sums ** 2).sum(axis=1) - squares), sums

    def probabilities(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        places, values, starts = _run(rows)
        return 1 / (1 + np.exp(-np.clip(self.margin(places, values, starts)[0], -30, 30)))


def _run(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = [len(p) for p, _ in rows]
    return np.concatenate([p for p, _ in rows]), np.concatenate([v for _, v in rows]), np.cumsum([0, *lengths[:-1]])


def improve(machine: Machine, squares: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
    """One Adagrad step over a batch, in place; ``squares`` (size, 1 + factors) holds squared gradients."""
    places, values, starts = _run(rows)
    margin, sums = machine.margin(places, values, starts)
    error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels
    row = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(places))))
    slope = (error[row] * values)[:, None]
    pull = np.hstack((slope, slope * (sums[row] - machine.factors[places] * values[:, None])))
    order = np.argsort(places, kind="stable")
    own, first = np.unique(places[order], return_index=True)
    now = np.hstack((machine.linear[own, None], machine.factors[own]))
    gradient = np.add.reduceat(pull[order], first) / len(rows) + DECAY * now
    squares[own] += gradient ** 2
    step = RATE * gradient / np.sqrt(squares[own] + 1e-8)
    machine.linear[own] -= step[:, 0]
    machine.factors[own] -= step[:, 1:]
    machine.bias -= RATE * error.mean()


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        made = [features(t, d) for t, d in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("n_chars").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([p.tobytes() for p, _ in made], pa.binary()),
                                          pa.array([v.tobytes() for _, v in made], pa.binary())], names=["doc_id", "label", "places", "vals"])


def _trainer(bias: float, linear: bytes, factors: bytes, squares: bytes, rate_round: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(bias, np.frombuffer(linear, np.float32).copy(), np.frombuffer(factors, np.float32).reshape(SIZE, FACTORS).copy())
        seen = np.frombuffer(squares, np.float32).reshape(SIZE, 1 + FACTORS).copy()
        rows, labels = [], []
        for batch in batches:
            for p, v, y in zip(batch.column("places").to_pylist(), batch.column("vals").to_pylist(), batch.column("label").to_pylist()):
                rows.append((np.frombuffer(p, np.int32), np.frombuffer(v, np.float32)))
                labels.append(y)
        order = np.random.default_rng(rate_round).permutation(len(rows))  # a bounded part of at most MAX_ROWS rows
        for at in range(0, len(order), BATCH):
            part = order[at: at + BATCH]
            improve(machine, seen, [rows[i] for i in part], np.array([labels[i] for i in part], np.float32))
        if rows:
            yield pa.RecordBatch.from_pydict({"n": [len(rows)], "bias": [float(machine.bias)], "linear": [machine.linear.tobytes()],
                                              "factors": [machine.factors.tobytes()], "squares": [seen.tobytes()]})

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, rounds: int = ROUNDS) -> Machine | float:
    """The fitted machine; without both labels the smoothed share of label 1."""
    known = training_rows(docs.withColumn("text", F.struct(F.col("text").alias("t"), _declared(docs).alias("n"))), labels, label, MODULUS, max_rows)
    known = known.select("doc_id", F.col("label").cast("int").alias("label"), F.col("text.t").alias("text"), F.col("text.n").alias("n_chars"))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total, good = sum(shares.values()), shares.get(1, 0)
    if not shares.get(0) or not good:
        return (good + 1) / (total + 2)
    parts = max(1, min(PARTITIONS, total // 512))
    sparse = save(map_batches(known, _sparse_rows, "doc_id long, label int, places binary, vals binary")
                  .repartition(parts, "doc_id").sortWithinPartitions("doc_id"), "sparse-rows")
    start = np.random.default_rng(3)
    machine = Machine(float(np.log(good / shares[0])), np.zeros(SIZE, np.float32), start.normal(0, 0.02, (SIZE, FACTORS)).astype(np.float32))
    squares = np.full((SIZE, 1 + FACTORS), 1e-3, np.float32)
    schema = "n long, bias double, linear binary, factors binary, squares binary"
    for k in range(rounds):
        run = _trainer(machine.bias, machine.linear.tobytes(), machine.factors.tobytes(), squares.tobytes(), k)
        found = map_batches(sparse, run, schema).collect()  # one set of parameters per partition, at most 8
        share = np.array([r["n"] for r in found]) / sum(r["n"] for r in found)
        mean = lambda name: sum(s * np.frombuffer(r[name], np.float32) for s, r in zip(share, found)).astype(np.float32)
        machine = Machine(float(sum(s * r["bias"] for s, r in zip(share, found))), mean("linear"), mean("factors").reshape(SIZE, FACTORS))
        squares = mean("squares").reshape(SIZE, 1 + FACTORS)
    return machine


def _declared(docs: DataFrame):
    return F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def _scorer(machine: Machine | float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=64):
            if isinstance(machine, float):
                scores = np.full(batch.num_rows, machine)
            else:
                scores = machine.probabilities([features(t, d) for t, d in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("n_chars").to_pylist())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores.astype(np.float64))], names=["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    machine = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _declared(docs).alias("n_chars"))
    scored = map_batches(rows, _scorer(machine), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), MODULUS).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
