"""Stored 1-based row numbers in file order (D8, WIN1), without a global sort.

``row_number() over (order by …)`` with no partition runs in one task.  Here
every file block is counted in parallel, the block offsets come from a window
over the *block counts* (one row per input split), and each row adds its
position inside its block.  The block table has one row per input split; how
it meets the rows (broadcast while small, else a shuffle) is left to the
optimizer, which knows its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import quoted
from tidemark.session import materialize, stored

ROW_NUMBER = "_row_number"
#: Most input splits whose table is sent to the tasks; a larger one meets the rows in a shuffle.
BROADCAST_BLOCKS = 50_000


def file_position(df: DataFrame) -> DataFrame:
    """Tag a file scan with ``_file`` and ``_block`` (path and split start)."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"))


def number_rows(tagged: DataFrame, name: str = ROW_NUMBER) -> DataFrame:
    """Consecutive 1-based ordinal over rows tagged by ``file_position``.

    Rows of one block are produced in file order inside one task (also after
    narrow steps such as an ``explode``), and ``monotonically_increasing_id``
    grows by one per row inside a task, so ``id - min(id) of the block`` is a
    row's position inside its block.
    """
    tagged = tagged.withColumn("_mid", F.monotonically_increasing_id())
    blocks = tagged.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    order = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_block", "_first",
                            F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_offset"))
    out = tagged.join(offsets, ["_file", "_block"])
    keep = [c for c in tagged.columns if c not in ("_file", "_block", "_mid")]
    return out.select(*[quoted(c) for c in keep],
                      (F.col("_offset") + (F.col("_mid") - F.col("_first")) + 1).alias(name))


def number_stored(tagged: DataFrame, name: str = ROW_NUMBER) -> DataFrame:
    """``number_rows`` for rows that are dear to make and read more than once: they are made once, stored with their position,
    and every later pass reads the stored ones.  The block table meets them where they are while it has few rows."""
    rows = stored(tagged.withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    blocks = materialize(rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first")))  # one row per split
    order = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_offset"))
    if blocks.count() <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    keep = [c for c in tagged.columns if c not in ("_file", "_block")]
    return rows.join(offsets, ["_file", "_block"]).select(
        *[quoted(c) for c in keep], (F.col("_offset") + (F.col("_mid") - F.col("_first")) + 1).alias(name))


def with_row_number(df: DataFrame, name: str = ROW_NUMBER) -> DataFrame:
    """Add a consecutive 1-based ordinal following (file path, block start, line).

    ``df`` must be a direct file scan (it reads ``_metadata``).
    """
    return number_rows(file_position(df), name)


def page(df: DataFrame, skip: int, limit: int, name: str = ROW_NUMBER) -> DataFrame:
    """SRC5: rows ``skip+1 .. skip+limit`` by stored ordinal — a range filter,
    not a sort, so it prunes row groups when the ordinal is stored in Parquet."""
    skip = max(0, int(skip))
    return df.where((F.col(name) > skip) & (F.col(name) <= skip + int(limit)))
