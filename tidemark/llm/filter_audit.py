"""Filter interaction audit by failing-id relations.

Five filters judge whole texts in one pass.  Every filter keeps one table of
the row ids that fail it; after that no text is read again.  What a prefix of
filters leaves does not depend on its order, so the 120 orders share 32
prefixes, and all of them come from these id tables by joins:

* *removals* of filter f after prefix S: f's failing ids left-anti each table of S;
* *survivors* of S: the ids that fail anything left-anti each table of S, and the ids
  that fail nothing (all ids left-anti the failing ones);
* *label losses*: f's failing ids left-semi the labelled ones, left-anti each table of S;
* *redundancies*: f's failing ids without its removals.

The prefixes grow together: for each filter every relation row is kept twice, without and with that filter
in its prefix, and one left-anti join drops the second kind where the id fails it.  All joins are on the
row id, which is unique, so no key is hot and one shuffle of the ids serves the whole chain.  Only
counts by part, filter and prefix leave the joins, pre-aggregated in every task.

Copies (filter E) are found by the SHA-256 of the text: the smallest doc_id of each digest is a partial aggregate.
Digests that hold a thousandth of all rows or more, at most a thousand, meet their rows by broadcast, the others in a shuffle.

Edge cases: null text is empty (it fails A, and E beside a smaller id with an empty text); a null doc_id is smaller
than none and has no label; rows are audited one by one, so repeated rows count each (equal ids are no smaller id);
a null source and an empty one are the same part; several label rows of one id count as quality or toxic when any is;
an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, save, slices
from tidemark.session import shared_path

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
SYMBOLS = b"#$%&*|"
#: A digest with at least this share of all rows is hot; so there are at most as many hot ones as its inverse.
HOT_SHARE = 0.001

_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(128, 192))


def judge(text: bytes) -> tuple[bool, bool, bool, bool]:
    """Failures of A to D for a UTF-8 text."""
    words = text.split()  # cuts at the six ASCII white-space bytes
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUATION))
    return (len(words) < MIN_WORDS, 100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
            100 * capitals > MAX_CAPITAL_PERCENT * points, len(text.translate(None, SYMBOLS)) < len(text))


def _judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        flags = zip(*map(judge, texts))
        digests = [hashlib.sha256(t).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("doc_id"), batch.column("part"),
             *(pa.array(f, pa.bool_()) for f in flags), pa.array(digests, pa.binary())],
            names=["row_id", "doc_id", "part", "A", "B", "C", "D", "digest"])


def judge_rows(docs: DataFrame) -> DataFrame:
    """Row id, doc_id, part, failures of A to D and the text's digest; written once, so the row ids stay."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    schema = "row_id long, doc_id long, part string, A boolean, B boolean, C boolean, D boolean, digest binary"
    return save(map_batches(rows, _judge_batches, schema), "audit-rows")


def later_copies(rows: DataFrame) -> DataFrame:
    """Rows whose text a smaller doc_id has too (filter E)."""
    groups = save(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
                  .where("n > 1"), "audit-copies")
    hot_from = max(1, int(rows.count() * HOT_SHARE))
    hot = F.broadcast(groups.where(F.col("n") >= hot_from).drop("n"))  # at most 1 / HOT_SHARE rows
    others = rows.join(hot, "digest", "left_anti").join(groups.where(F.col("n") < hot_from).drop("n"), "digest")
    return rows.join(hot, "digest").unionByName(others).where("doc_id > first_id").select(*rows.columns)


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One table (row_id, doc_id, part) per filter, stored in a folder of its own."""
    spark = rows.sparkSession
    columns = ["row_id", "doc_id", "part"]
    flags = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in "ABCD"]))
    failed = rows.select(*columns, F.explode(flags).alias("filter")).unionByName(
        later_copies(rows).select(*columns, F.lit("E").alias("filter")))
    path = shared_path(spark, "llm", "audit-failing")
    failed.write.partitionBy("filter").parquet(path)
    stored = spark.read.schema(failed.schema).option("basePath", path).parquet(path)
    return {f: stored.where(F.col("filter") == f).select(*columns) for f in FILTERS}


def prefix_relations(rows: DataFrame, failing: dict[str, DataFrame], labels: DataFrame) -> DataFrame:
    """(kind, filter, prefix, row_id, part): for every prefix (a bit per filter) the ids it leaves of each relation.

    Kinds: ``fails`` (a filter's failing ids: its removals after that prefix), ``good`` and ``toxic`` (those with that
    label), ``alive`` (ids that fail any filter: the survivors among them).
    """
    def relation(ids: DataFrame, kind: str, name: str) -> DataFrame:
        return ids.select("row_id", "part", F.lit(kind).alias("kind"), F.lit(name).alias("filter"))

    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    toxic = labels.where("toxic = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    failed_any = None
    found = None
    for name, ids in failing.items():
        failed_any = ids.select("row_id", "part") if failed_any is None else failed_any.unionByName(ids.select("row_id", "part"))
        for part in (relation(ids, "fails", name), relation(ids.join(good, "doc_id", "left_semi"), "good", name),
                     relation(ids.join(toxic, "doc_id", "left_semi"), "toxic", name)):
            found = part if found is None else found.unionByName(part)
    found = found.unionByName(relation(failed_any.distinct(), "alive", "")).withColumn("prefix", F.lit(0))
    for k, (name, ids) in enumerate(failing.items()):
        both = F.when(F.col("filter") == name, F.array("prefix")).otherwise(F.array("prefix", F.col("prefix") + (1 << k)))
        found = found.withColumn("prefix", F.explode(both))
        gone = ids.select(F.col("row_id").alias("failed_id"))
        found = found.join(gone, (F.col("row_id") == F.col("failed_id")) & (F.col("prefix").bitwiseAND(1 << k) != 0), "left_anti")
    return found


def prefix_counts(rows: DataFrame, failing: dict[str, DataFrame], labels: DataFrame) -> DataFrame:
    """(part, kind, filter, prefix, n); kind ``clean`` counts the rows that fail nothing."""
    counts = prefix_relations(rows, failing, labels).groupBy("part", "kind", "filter", "prefix").agg(F.count("*").alias("n"))
    clean = rows.select("row_id", "part")
    for ids in failing.values():
        clean = clean.join(ids.select("row_id"), "row_id", "left_anti")
    clean = clean.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.lit("clean").alias("kind"), F.lit("").alias("filter"), F.lit(0).alias("prefix"), "n")
    return counts.unionByName(clean)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rows = judge_rows(docs)
    counts = save(prefix_counts(rows, failing_ids(rows), labels), "audit-counts")
    # at most 3 x 5 x 16 + 32 + 1 counts of a part
    key = F.concat_ws("|", "kind", "filter", F.col("prefix").cast("string"))
    of_part = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(key, "n"))).alias("counts"))
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    steps = (of_part.withColumn("filter_order", F.explode(orders))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))))
    filter_ = F.substring("filter_order", F.col("step"), F.lit(1))
    before = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    prefix = sum((F.when(F.contains(before, F.lit(f)), 1 << k).otherwise(0) for k, f in enumerate(FILTERS)), F.lit(0))
    bit = sum((F.when(filter_ == f, 1 << k).otherwise(0) for k, f in enumerate(FILTERS)), F.lit(0))
    steps = steps.withColumns({"filter": filter_, "prefix": prefix, "bit": bit})

    def count(kind: str, name, at) -> F.Column:
        return F.coalesce(F.element_at("counts", F.concat_ws("|", F.lit(kind), name, at.cast("string"))), F.lit(0)).cast("long")

    name, at = F.col("filter"), F.col("prefix")
    removed = count("fails", name, at)
    everything = (1 << len(FILTERS)) - 1
    out = steps.select(
        "part", "filter_order", "step", "filter",
        (count("clean", F.lit(""), F.lit(0)) + count("alive", F.lit(""), at + F.col("bit"))).alias("kept"),
        removed.alias("removed"), (count("fails", name, F.lit(0)) - removed).alias("redundant"),
        count("fails", name, F.lit(everything) - F.col("bit")).alias("unique_fails"),
        count("good", name, at).alias("good_lost"), count("toxic", name, at).alias("toxic_lost"))
    same = Window.partitionBy("part", "filter")  # one row per order
    return out.withColumn("shapley", F.sum("removed").over(same)).drop("filter")


def oracle_sql() -> str:
    """The same table from one failure mask per document."""
    bits = {f: 1 << k for k, f in enumerate(FILTERS)}
    tests = " + ".join(f"CASE WHEN {f} THEN {b} ELSE 0 END" for f, b in bits.items())
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
         w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
         j AS (SELECT doc_id, part, len(words) < {MIN_WORDS} AS A, 100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words) AS B,
                      100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_CAPITAL_PERCENT} * length(t) AS C,
                      regexp_matches(t, '[{SYMBOLS.decode()}]') AS D, coalesce(doc_id > first_id, false) AS E FROM w),
         m AS (SELECT part, {tests} AS mask, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
                      doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM j),
         c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
               FROM m GROUP BY ALL),
         f AS (SELECT * FROM (VALUES {", ".join(f"('{f}', {b})" for f, b in bits.items())}) v(l, b)),
         o AS (SELECT [a.l, b.l, c.l, d.l, e.l] AS ls, [a.b, b.b, c.b, d.b, e.b] AS bs
               FROM f a JOIN f b ON b.b <> a.b JOIN f c ON c.b NOT IN (a.b, b.b) JOIN f d ON d.b NOT IN (a.b, b.b, c.b)
                    JOIN f e ON e.b NOT IN (a.b, b.b, c.b, d.b)),
         s AS (SELECT array_to_string(ls, '') AS filter_order, CAST(step AS INT) AS step, bs[step] AS bit,
                      coalesce(list_sum(bs[1:step - 1]), 0)::BIGINT AS before FROM o, range(1, 6) r(step)),
         r AS (SELECT part, filter_order, step, bit, sum(n) FILTER (WHERE mask & (before | bit) = 0) AS kept,
                      sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before = 0) AS removed,
                      sum(n) FILTER (WHERE mask & bit <> 0 AND mask & before <> 0) AS redundant,
                      sum(n) FILTER (WHERE mask = bit) AS unique_fails,
                      sum(c.good) FILTER (WHERE mask & bit <> 0 AND mask & before = 0) AS good_lost,
                      sum(c.toxic) FILTER (WHERE mask & bit <> 0 AND mask & before = 0) AS toxic_lost FROM c, s GROUP BY ALL)
    SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
           coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
           coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
           (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""
