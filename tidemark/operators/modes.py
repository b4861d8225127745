"""Most common value of many columns with certified heavy hitters (AGG9, SRT3).

Counting every distinct cell of every text column shuffles them all, though most columns have a value that stands out.  Here:

1. *Summaries.*  One aggregate keeps a frequent-items summary per column over 64-bit hashes of its cells.  Its size is fixed,
   whatever the cells are, and summaries of tasks merge.
2. *Recount.*  The cells whose hash is among a column's few candidates are counted exactly, by value.
3. *Certificate.*  A value that is not a candidate has at most ``bound`` cells: the last returned estimate, or twice the summary's
   error.  Where the recounted winner has more, it is the mode, and all values that tie with it were candidates too.
4. *Rest.*  Only columns without a certificate, as those of unique ids, are counted in full.

So the shuffle does not grow with the distinct cells of certified columns, and the result is exact for all.
Ties go to the smallest text; blank and NULL cells are not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import py_strip
from tidemark.session import materialize

CANDIDATES = 8
TRACKED = 10_000
#: Error of a summary over n cells is at most n times this over the number of tracked items.
ERROR_FACTOR = 3.5


def _cells(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(name).alias("column"), text.alias("value")) for name, text in texts.items()])
    return (df.select(F.explode(entries).alias("cell")).select("cell.column", "cell.value")
            .where(F.col("value").isNotNull() & (py_strip(F.col("value")) != F.lit(""))))


def _winners(counts: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))).alias("best")
    return counts.groupBy("column").agg(best).select("column", "best.value", (-F.col("best.neg")).alias("n"))


def cell_counts(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """(column, value, n) of every distinct cell."""
    return _cells(df, texts).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def summaries(df: DataFrame, texts: dict[str, Column], tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """(column, hashes of the candidates, bound on any other value's cells), a row per column."""
    aggs = [F.count(F.lit(1)).alias("cells")]
    for k, text in enumerate(texts.values()):
        cell = F.when(py_strip(text) != F.lit(""), F.xxhash64(text))
        aggs.append(F.call_function("approx_top_k", cell, F.lit(candidates), F.lit(tracked)).alias(f"top{k}"))
    entries = F.array(*[F.struct(F.lit(name).alias("column"), F.col(f"top{k}").alias("top")) for k, name in enumerate(texts)])
    rows = df.agg(*aggs).select("cells", F.explode(entries).alias("e")).select("cells", "e.*")
    last = F.when(F.size("top") == candidates, F.element_at("top", -1)["count"]).otherwise(F.lit(0))
    error = F.ceil(F.col("cells") * F.lit(2 * ERROR_FACTOR / tracked))
    return rows.select("column", F.filter(F.col("top")["item"], lambda h: h.isNotNull()).alias("hashes"), F.greatest(last, error).alias("bound"))


def certified_modes(df: DataFrame, texts: dict[str, Column], tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """(column, value, n, certified): the winners of ``cell_counts``; columns without a cell have no row."""
    summary = materialize(summaries(df, texts, tracked, candidates))  # one row per column
    cells = _cells(df, texts)
    asked = F.broadcast(summary.select("column", F.explode("hashes").alias("hash")))  # at most ``candidates`` rows per column
    recount = (cells.withColumn("hash", F.xxhash64("value")).join(asked, ["column", "hash"])
               .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    sure = materialize(_winners(recount).join(F.broadcast(summary.select("column", "bound")), "column").where("n > bound")
                       .select("column", "value", "n", F.lit(True).alias("certified")))
    unsure = F.broadcast(summary.select("column").join(sure.select("column"), "column", "left_anti"))  # at most a row per column
    rest = _winners(cells.join(unsure, "column", "left_semi").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    return sure.unionByName(rest.withColumn("certified", F.lit(False)))
