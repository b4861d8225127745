"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

The features of a whole text are lexicon densities, closeness of lexicon words to the
second person, capitals, punctuation and obfuscation rates.  The lexicon is a short fixed list
of insults and what the labelled rows teach: words and word beginnings with their
log odds among toxic rows.

Fitting takes at most ``MAX_ROWS`` labelled rows, those with the smallest hash of their id,
dealt into three folds: one teaches the lexicon, one grows the trees, one
calibrates, so no stage is judged on what it was taught from.  Scoring covers every row.

Edge cases: null or empty text has features of zero and is scored like any other; rows that repeat a doc_id are scored one by one;
null labels or ids teach nothing; without labelled rows of both classes every score is the smoothed share of
label 1 (0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, map_batches, save, ship_package, slices

MAX_ROWS = 20_000
MAX_TERMS = 4_096
MIN_DOCS = 3
MIN_WEIGHT = 0.7  # of the log odds less 1.64 standard errors
THRESHOLD = 0.3
MODULUS = 4
TREES, DEPTH = 20, 4
_NEAR = 4
_PREFIXES = (4, 5)

# Insults and second-person words.
INSULTS = """asshole bastard bitch clown creep disgusting dumb fool freak garbage hate idiot imbecile jerk kill
loser lunatic moron pathetic pig psycho retard scum shit stupid trash ugly vermin whore worthless
abschaum arschloch dumm dreck hure idioten müll schwein versager wertlos
con connard crétin déchet imbécile merde minable ordure salaud salope stupide
basura cabrón cerdo escoria estúpido idiota imbécil inútil mierda puta""".split()
SECOND_PERSON = """you your yours yourself yourselves u ur du dich dir dein deine euch euer ihr tu te toi ton ta tes vous
votre vos tú ti tus usted ustedes vosotros""".split()
_FOLD = bytes.maketrans(b"01345789@$!", b"oieastbgasi")

_KEEP = bytes(c if 97 <= c <= 122 or c >= 128 or c == 39 else 32 for c in range(256))
_MIXED = re.compile(rb"[A-Za-z]+[0-9@$!*#]+[A-Za-z]+")
_MASKED = re.compile(rb"[A-Za-z][*#]{2,}|[*#]{2,}[A-Za-z]")
_SHOUT = re.compile(rb"\b[A-Z]{3,}\b")

FEATURES = ("log_words", "word_density", "prefix_density", "top_weight", "log_hits", "log_distinct", "insult_density", "insult_hits",
            "near_second_person", "second_person", "capitals", "shouted", "exclaimed", "punctuation", "symbols", "digits",
            "mixed", "masked", "stretched", "folded_hits")


def plain_words(text: str) -> list[bytes]:
    """Lower-case runs of letters (every character beyond ASCII counts as one) as UTF-8."""
    return text.lower().encode().translate(_KEEP).split()


def _terms(words: set[bytes]) -> set[bytes]:
    """Words, and beginnings marked by a trailing asterisk."""
    return words.union(*({w[:k] + b"*" for w in words if len(w) >= k} for k in _PREFIXES))


class FeatureMaker:
    def __init__(self, lexicon: dict[bytes, float]):
        self._words = {t: w for t, w in lexicon.items() if not t.endswith(b"*")}
        self._starts = {k: {t[:-1]: w for t, w in lexicon.items() if t.endswith(b"*") and len(t) == k + 1} for k in _PREFIXES}
        self._insults = {w.encode() for w in INSULTS}
        self._second = {w.encode() for w in SECOND_PERSON}

    def _weight(self, word: bytes) -> tuple[float, float]:
        return self._words.get(word, 0.0), max((s.get(word[:k], 0.0) for k, s in self._starts.items()), default=0.0)

    def __call__(self, text: str | None) -> list[float]:
        out = [0.0] * len(FEATURES)
        if not text:
            return out
        raw = text.encode()
        words = plain_words(text)
        n, size = max(1, len(words)), len(raw)
        distinct = set(words)
        hit = self._words.keys() & distinct
        for k, starts in self._starts.items():
            if starts and (found := starts.keys() & {w[:k] for w in distinct}):
                hit |= {w for w in distinct if w[:k] in found}
        insults = self._insults & distinct
        out[0] = np.log1p(len(words))
        if hit or insults:
            weights = {w: self._weight(w) for w in hit}
            at = [i for i, w in enumerate(words) if w in weights or w in insults]
            you = [i for i, w in enumerate(words) if w in self._second]
            out[1] = 100 * sum(weights[words[i]][0] for i in at if words[i] in weights) / n
            out[2] = 100 * sum(weights[words[i]][1] for i in at if words[i] in weights) / n
            out[3] = max((max(w) for w in weights.values()), default=0.0)
            out[4], out[5] = np.log1p(len(at)), np.log1p(len(hit | insults))
            rude = sum(words[i] in insults for i in at)
            out[6], out[7] = 100 * rude / n, np.log1p(rude)
            if you:
                place = np.searchsorted(you, at)
                ahead = [abs(you[min(p, len(you) - 1)] - i) <= _NEAR or abs(you[max(p - 1, 0)] - i) <= _NEAR for p, i in zip(place, at)]
                out[8] = 100 * sum(ahead) / n
        out[9] = 100 * sum(w in self._second for w in distinct) / n
        array = np.frombuffer(raw, np.uint8)
        count = np.bincount(array, minlength=128)
        out[10] = count[65:91].sum() / size
        out[11] = 100 * len(_SHOUT.findall(raw)) / n
        out[12] = 100 * (count[33] + count[63]) / n
        out[13] = (count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()) / size
        out[14] = (count[35:39].sum() + count[42] + count[64] + count[124]) / size
        out[15] = count[48:58].sum() / size
        mixed = _MIXED.findall(raw)
        out[16] = 100 * len(mixed) / n
        out[17] = 100 * len(_MASKED.findall(raw)) / n
        same = array[1:] == array[:-1]
        out[18] = 100 * np.count_nonzero(same[1:] & same[:-1] & (array[2:] >= 65)) / n
        folded = {w.translate(_FOLD).lower() for w in mixed}
        out[19] = 100 * len({w for w in folded if w in self._insults or any(self._weight(w))}) / n
        return [float(x) for x in out]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, max_rows: int) -> DataFrame:
    """doc_id, text, label, fold (0..9) of at most ``max_rows`` labelled rows outside the held-out part."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(~held_out(F.col("doc_id"), modulus) & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # at most max_rows small rows: fit to broadcast
    fold = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(10))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return save(texts.join(F.broadcast(chosen), "doc_id").withColumn("fold", fold), f"{label}-rows")


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, toxic = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        terms = list(counts)
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), pa.array([counts[t] for t in terms], pa.int64()),
                                           pa.array([toxic[t] for t in terms], pa.int64())], names=["term", "docs", "toxic"])

    for batch in slices(batches):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            terms = _terms(set(plain_words(text or "")))
            counts.update(terms)
            if label == 1:
                toxic.update(terms)
        if len(counts) > 300_000:
            yield flush()
            counts.clear()
            toxic.clear()
    yield flush()


def learn_lexicon(rows: DataFrame, max_terms: int = MAX_TERMS) -> dict[bytes, float]:
    """Terms that toxic rows hold more often, with their smoothed log odds; at most ``max_terms``."""
    totals = rows.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    n, t = totals["n"], totals["t"] or 0
    if not 0 < t < n:
        return {}
    terms = map_batches(rows.select("text", "label"), _term_counts, "term binary, docs long, toxic long")
    terms = terms.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")).where(f"toxic >= {MIN_DOCS}")
    here, there = F.col("toxic") + 0.5, F.col("docs") - F.col("toxic") + 0.5
    terms = terms.withColumn("weight", F.log(here / (t + 1) / (there / (n - t + 1))))
    sure = F.col("weight") - 1.64 * F.sqrt(1 / here + 1 / there)
    best = terms.where(sure >= MIN_WEIGHT).orderBy(F.desc(F.col("weight") * F.log1p("toxic")), "term").limit(max_terms)
    return {bytes(r["term"]): r["weight"] for r in best.select("term", "weight").collect()}


def _feature_column(text: Column, lexicon: dict[bytes, float]) -> Column:
    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make = FeatureMaker(lexicon)
        for texts in batches:
            yield pd.Series([make(t) for t in texts])

    return features(text)


@dataclass
class ToxicityModel:
    lexicon: dict[bytes, float]
    trees: object | None
    calibration: object | None
    base_rate: float

    def score(self, docs: DataFrame) -> DataFrame:
        """row (all columns of ``docs`` as a struct), score and predicted of every row."""
        from pyspark.ml.functions import array_to_vector, vector_to_array

        ship_package(docs.sparkSession)
        rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
        if self.trees is None:
            scored = rows.withColumn("score", F.lit(self.base_rate))
        else:
            made = rows.withColumn("features", array_to_vector(_feature_column(F.col("row.text"), self.lexicon)))
            grown = self.trees.transform(made).withColumn("p", vector_to_array("probability").getItem(1)).drop("features", "rawPrediction", "probability", "prediction")
            # the calibrated value has steps; a hundredth of the uncalibrated one keeps the order within a step
            scored = self.calibration.transform(grown).withColumn("score", 0.99 * F.col("calibrated") + 0.01 * F.col("p"))
        return scored.select("row", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = MODULUS, max_rows: int = MAX_ROWS) -> ToxicityModel:
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    ship_package(docs.sparkSession)
    rows = training_rows(docs, labels, label, modulus, max_rows)
    seen = {(r["part"], r["label"]): r["n"] for r in rows.groupBy(F.when(F.col("fold") < 5, "lexicon").when(F.col("fold") < 8, "trees").otherwise("calibration").alias("part"), "label").agg(F.count("*").alias("n")).collect()}
    n, toxic = sum(seen.values()), sum(v for (_, y), v in seen.items() if y == 1)
    base = (toxic + 1) / (n + 2)
    if any((part, y) not in seen for part in ("trees", "calibration") for y in (0, 1)):
        return ToxicityModel({}, None, None, base)
    lexicon = learn_lexicon(rows.where("fold < 5"))
    made = save(rows.where("fold >= 5").select("doc_id", "fold", F.col("label").cast("double").alias("label"), _feature_column(F.col("text"), lexicon).alias("f")), "toxicity-features")
    made = made.withColumn("features", array_to_vector("f"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=3, seed=11).fit(made.where("fold < 8"))
    judged = trees.transform(made.where("fold >= 8")).select("label", vector_to_array("probability").getItem(1).alias("p"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="calibrated").fit(judged)
    return ToxicityModel(lexicon, trees, calibration, base)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = fit(docs, labels).score(docs.select("doc_id", "text"))
    return scored.select("row.doc_id", held_out(F.col("row.doc_id"), MODULUS).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns."""
    return fit(docs, labels).score(docs).where("predicted = 0").select("row.*")
