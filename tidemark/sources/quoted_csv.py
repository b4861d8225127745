"""Report CSV with line breaks inside quoted cells, scanned by many tasks (SRC4).

Where a line starts inside a quoted cell cannot be seen from the line, nor from
its input split.  Every line is, however, a function from "a cell is open before
it" to "a cell is open after it", and such functions compose:

1. *Scan.*  Each task walks its splits once and notes for every line, under both assumptions about the split's
   start, whether a cell is open before and after it and how many records have started so far.  Lines without a
   quote change nothing and are handled as whole Arrow columns.  The noted lines are stored once.
2. *Settle.*  One row per split holds its function and its record counts.  A window per file composes them, which
   gives each split its true start and the number of records before it.  A cell that is never closed is an error.
3. *Cut.*  A line that is a record stays where it stands.  The lines of a longer record share its number; those that follow one
   another in a task are joined there, and only records that are spread over tasks or batches meet in a shuffle.  The
   fragments are stored once, for the pass that decides types and those that read the cells.

A task scans many splits in turn, so that small splits do not each pay for a task.

A quote opens a cell only at its start, as in RFC 4180; elsewhere it is an ordinary character.  Inside an open cell a doubled quote
is a quote, and what follows the closing one up to the separator is kept as it stands.  Lines end at a line feed, with or without
a carriage return before it; breaks inside a cell keep their bytes.  Blank lines outside cells are no records.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.values import quoted
from tidemark.session import materialize, shared_path, stored
from tidemark.sources.ordinal import ROW_NUMBER, file_position

SEPARATOR = ";"
#: Bytes of input that one task scans at least, in as many splits as that takes, once every core has work.
TASK_BYTES = 16 * 1024 * 1024
_OPTIONS = {"sep": SEPARATOR, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
_LINES = ("value string, _file string, _block long, line long, open0 boolean, open1 boolean, after0 boolean, after1 boolean, "
          "records0 long, records1 long, blank boolean")


@contextmanager
def split_size(spark: SparkSession, size: int | None):
    """Input splits of at most ``size`` bytes for the scans planned inside; unchanged when None."""
    if size is None:
        yield
        return
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def self_contained(value: Column) -> Column:
    """True for a line that neither leaves a cell open nor needs to know whether one was."""
    cell = r'(?:"[^"]*+(?:""[^"]*+)*+"[^;]*+|[^";][^;]*+|)'
    return ~F.contains(value, F.lit('"')) | value.rlike(rf"\A{cell}(?:;{cell})*+\r?\z")


def has_quoted_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any line of the report leaves a quoted cell open; stops at the first one found."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return not lines.where(~self_contained(F.col("value"))).limit(1).isEmpty()


def _line_states(separator: str):
    def ends(line: str, inside: bool) -> bool:
        at = 0
        while True:
            if inside:
                at = line.find('"', at)
                while at >= 0 and line.startswith('""', at):
                    at = line.find('"', at + 2)
                if at < 0:
                    return True
                at = line.find(separator, at + 1)
            elif line.startswith('"', at):
                inside, at = True, at + 1
                continue
            else:
                at = line.find(separator, at)
            if at < 0:
                return False
            inside, at = False, at + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        current, line, states, counts = None, 0, (False, True), (0, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column("_file"), batch.column("_block").to_numpy()
            moved = pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False) | (blocks[1:] != blocks[:-1])
            edges = [0, *(np.flatnonzero(moved) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                part = batch.slice(low, high - low)
                split = (part.column("_file")[0].as_py(), part.column("_block")[0].as_py())
                if split != current:
                    current, line, states, counts = split, 0, (False, True), (0, 0)
                value = part.column("value")
                blank = pc.equal(pc.utf8_length(pc.utf8_trim_whitespace(value)), 0).to_numpy(zero_copy_only=False)
                quotes = np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False))
                n = high - low
                before = np.empty((2, n + 1), bool)
                at = 0
                for k in quotes.tolist():
                    for a in (0, 1):
                        before[a, at: k + 1] = states[a]
                    text = value[k].as_py()
                    after = (ends(text, False), ends(text, True))
                    states, at = (after[states[0]], after[states[1]]), k + 1
                for a in (0, 1):
                    before[a, at:] = states[a]
                started = [counts[a] + np.cumsum(~before[a, :n] & ~blank) for a in (0, 1)]
                counts = (int(started[0][-1]), int(started[1][-1]))
                yield pa.RecordBatch.from_arrays(
                    [value, part.column("_file"), part.column("_block"), pa.array(np.arange(line, line + n)),
                     pa.array(before[0, :n]), pa.array(before[1, :n]), pa.array(before[0, 1:]), pa.array(before[1, 1:]),
                     pa.array(started[0]), pa.array(started[1]), pa.array(blank)],
                    names=["value", "_file", "_block", "line", "open0", "open1", "after0", "after1", "records0", "records1", "blank"])
                line += n

    return run


def scan_lines(spark: SparkSession, path: str, *, split_bytes: int | None = None) -> DataFrame:
    """Every line with its states under both assumptions; stored, so that later steps see the same splits."""
    target = shared_path(spark, "staging", "csv-lines")
    total = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.sum("length")).first()[0] or 0  # sizes only
    tasks = max(4 * spark.sparkContext.defaultParallelism, total // TASK_BYTES)
    with split_size(spark, split_bytes):
        lines = file_position(spark.read.option("lineSep", "\n").text(path))
        lines.coalesce(int(tasks)).mapInArrow(_line_states(SEPARATOR), _LINES).write.parquet(target)  # no shuffle: splits one after another
    return spark.read.schema(_LINES).parquet(target)


def settle(lines: DataFrame) -> DataFrame:
    """One row per split: whether a cell is open at its start, and the records before it (in all files, and in its own)."""
    splits = lines.groupBy("_file", "_block").agg(
        F.max_by("after0", "line").alias("after0"), F.max_by("after1", "line").alias("after1"),
        F.max("records0").alias("records0"), F.max("records1").alias("records1"))
    in_file = Window.partitionBy("_file").orderBy("_block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # A split that ends the same way under both assumptions forgets its start; otherwise it keeps it or turns it round.
    fixed, turns = F.col("after0") == F.col("after1"), (F.col("after0") & ~F.col("after1")).cast("int")
    splits = splits.withColumn("_turns", F.sum(turns).over(in_file))
    last = F.last(F.when(fixed, F.struct("after0", "_turns")), ignorenulls=True).over(earlier)
    turned = F.coalesce(F.lag("_turns").over(in_file), F.lit(0)) - F.coalesce(last["_turns"], F.lit(0))
    opened = F.coalesce(last["after0"], F.lit(False)) != (turned % 2 == 1)
    splits = splits.withColumn("open", opened)
    splits = splits.withColumns({"ends_open": F.when(F.col("open"), F.col("after1")).otherwise(F.col("after0")),
                                 "n": F.when(F.col("open"), F.col("records1")).otherwise(F.col("records0"))})
    overall = Window.orderBy("_file", "_block")  # one row per split
    return splits.select(
        "_file", "_block", "open", "ends_open",
        F.coalesce(F.sum("n").over(overall.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_in_file"),
        F.dense_rank().over(Window.orderBy("_file")).alias("file_number"))


def _line_joiner():
    """Consecutive lines of one record as one fragment; other lines as they are."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            number, file, block, line = (batch.column(c).to_numpy() for c in (ROW_NUMBER, "file_number", "_block", "line"))
            follows = (number[1:] == number[:-1]) & (file[1:] == file[:-1]) & (block[1:] == block[:-1]) & (line[1:] == line[:-1] + 1)
            starts = np.flatnonzero(np.concatenate(([True], ~follows)))
            ends = np.append(starts[1:], n)
            value = batch.column("value")
            if len(starts) < n:
                cells = value.to_pylist()
                value = pa.array([cells[a] if b == a + 1 else "\n".join(cells[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], pa.string())
            first, last = pa.array(starts), pa.array(ends - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW_NUMBER).take(first), batch.column("file_number").take(first), batch.column("_block").take(first),
                 batch.column("line").take(first), batch.column("inside").take(first), batch.column("continues").take(last), value],
                names=[ROW_NUMBER, "file_number", "_block", "line", "inside", "continues", "value"])

    return run


_FRAGMENTS = f"{ROW_NUMBER} long, file_number int, _block long, line long, inside boolean, continues boolean, value string"


def _column_names(header: str) -> list[str]:
    cells = next(csv.reader([header.removeprefix("﻿")], delimiter=SEPARATOR), [])
    names: list[str] = []
    for k, cell in enumerate(cells):
        names.append(f"_c{k}" if not cell else f"{cell}{k}" if cells.count(cell) > 1 else cell)
    return names


def read_quoted_csv(spark: SparkSession, path: str, *, split_bytes: int | None = None) -> DataFrame:
    """Cells of all records as text, with the stored row number; the first record of each file is its header."""
    lines = scan_lines(spark, path, split_bytes=split_bytes)
    splits = materialize(settle(lines))
    broken = splits.groupBy("_file").agg(F.max_by("ends_open", "_block").alias("open")).where("open").select("_file").take(1)
    if broken:
        raise ValueError(f"a quoted cell is never closed in {broken[0]['_file']}")
    placed = lines.join(F.broadcast(splits), ["_file", "_block"])  # one row per split
    pick = lambda a, b: F.when(F.col("open"), F.col(b)).otherwise(F.col(a))
    record = pick("records0", "records1")
    placed = placed.select(
        "value", "_file", "_block", "line", "blank", pick("open0", "open1").alias("inside"), pick("after0", "after1").alias("continues"),
        (F.col("before") + record - F.col("file_number")).alias(ROW_NUMBER),
        (F.col("before_in_file") + record).alias("in_file"), "file_number", "records0", "records1")
    first_file = splits.agg(F.min("_file")).first()[0]
    heading = (placed.where((F.col("_file") == first_file) & ((F.col("records0") <= 1) | (F.col("records1") <= 1)))  # reaches the scan
               .where("in_file = 1 AND (inside OR NOT blank)").select("_block", "line", "value").collect())  # one record
    names = _column_names("\n".join(r["value"] for r in sorted(heading)).removesuffix("\r"))
    lines_of_records = placed.where("in_file > 1 AND (inside OR continues OR NOT blank)")
    fragments = stored(lines_of_records.select(
        ROW_NUMBER, F.col("file_number").cast("int").alias("file_number"), "_block", "line", "inside", "continues", "value").mapInArrow(_line_joiner(), _FRAGMENTS), "csv-records")
    whole = fragments.where("NOT inside AND NOT continues").select(ROW_NUMBER, "value")
    parts = fragments.where("inside OR continues").groupBy(ROW_NUMBER).agg(
        F.sort_array(F.collect_list(F.struct("file_number", "_block", "line", "value"))).alias("parts"))  # the fragments of one record
    text = whole.unionByName(parts.select(ROW_NUMBER, F.array_join("parts.value", "\n").alias("value")))
    schema = ", ".join(f"c{k} string" for k in range(len(names)))
    cells = F.from_csv(F.regexp_replace("value", r"\r\z", ""), schema, _OPTIONS)
    parsed = text.select(cells.alias("r"), ROW_NUMBER) if names else text.select(ROW_NUMBER)
    return parsed.select(*[F.col(f"r.c{k}").alias(name) for k, name in enumerate(names)], quoted(ROW_NUMBER))
