"""Best-fit packing with large-item matching.

Documents become id sequences closed by an end id; a longer one is cut into
full pieces, and its first piece takes the remainder.  Piece lengths are
integers up to the capacity, so the packing of any number of pieces is decided on
the table of counts per length, which has at most ``capacity`` rows:

1. *Large-item matching.*  No bin holds three pieces above a third of the
   capacity, so these pair at most twice per bin.  From the longest down, a
   length is matched with the longest partner that still fits.
2. *Best fit.*  Smaller lengths, from the longest down, go to the smallest
   gap that holds them; new bins open when no gap is left.

Bins that look alike are one *pattern* with a multiplicity, so the plan's size depends on the
capacity, not on the number of documents.  Every piece then finds its
place by its rank within its length: counts per task and length are summed
into offsets by a window over tasks, so no length, however frequent, is gathered
in one task.

Edge cases: null or empty text is one piece holding the end id alone; repeated rows are
packed once per row; a null doc_id is carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, save, slices
from tidemark.llm.tokens import END_ID, encoder, tokenizer_path

CAPACITY = 1024

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("task", pa.int32()), ("rank_in_task", pa.int64())])


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: full ones, the first may be shorter."""
    first = total % capacity
    return ([first] if first else []) + [capacity] * (total // capacity)


def _cutter(path: str, capacity: int, end_id: int, keep_ids: bool):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path).encode, TaskContext.get().partitionId()
        ranks = [0] * (capacity + 1)
        for batch in slices(batches):
            rows: dict[str, list] = {f.name: [] for f in _PIECES}
            kept = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                ids, start = ids + end, 0
                for piece, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                    part = ids[4 * start: 4 * (start + length)]
                    for name, value in zip(rows, (doc_id, piece, start, length, zlib.crc32(part), task, ranks[length])):
                        rows[name].append(value)
                    if keep_ids:
                        kept.append(part)
                    ranks[length] += 1
                    start += length
            arrays = [pa.array(rows[f.name], f.type) for f in _PIECES]
            names = _PIECES.names
            if keep_ids:
                arrays, names = [*arrays, pa.array(kept, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
               keep_ids: bool = False) -> DataFrame:
    """Pieces of every document with the task that cut them and their rank in it; written once."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank_in_task long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = map_batches(rows, _cutter(tokenizer or tokenizer_path(), capacity, end_id, keep_ids),
                      schema + (", ids binary" if keep_ids else ""))
    return save(cut, "pieces")


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (piece lengths of one bin, in order) with the number of such bins."""
    left = {s: n for s, n in counts.items() if n > 0}
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    open_gaps: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], number: int) -> None:
        gap = capacity - sum(pattern)
        if not gap:
            done.append((pattern, number))
            return
        if gap not in gaps:
            gaps[gap] = []
            bisect.insort(open_gaps, gap)
        gaps[gap].append((pattern, number))

    large = sorted(s for s in left if 3 * s > capacity)
    for size in reversed(large):
        while left[size]:
            # the longest large length not above `size` that fits beside it
            at = bisect.bisect_right(large, min(capacity - size, size)) - 1
            while at >= 0 and (left[large[at]] == 0 or (large[at] == size and left[size] < 2)):
                at -= 1
            if at < 0:
                number, pattern = left[size], (size,)
            elif large[at] == size:
                number, pattern = left[size] // 2, (size, size)
            else:
                number, pattern = min(left[size], left[large[at]]), (size, large[at])
            for s in pattern:
                left[s] -= number
            put(pattern, number)
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            at = bisect.bisect_left(open_gaps, size)
            if at == len(open_gaps):
                gap, pattern, number = capacity, (), left[size]  # a new bin for each, as far as needed
            else:
                gap = open_gaps[at]
                pattern, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[at]
            each = min(gap // size, left[size])
            filled = min(number, left[size] // each)
            put(pattern + (size,) * each, filled)
            left[size] -= filled * each
            if pattern and number > filled:
                put(pattern, number - filled)
    return done + [group for gap in open_gaps for group in gaps[gap]]


def slots(bins: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank of each slot, sequence id of that rank, offset in the sequence."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, number in bins:
        offset = 0
        for size in pattern:
            found.setdefault(size, []).append((used.get(size, 0), sequence, offset))
            used[size] = used.get(size, 0) + number
            offset += size
        sequence += number
    return {s: tuple(np.array(x, np.int64) for x in zip(*rows)) for s, rows in found.items()}


def _placer(plan: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                first, base, place = plan[int(size)]
                slot = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows] = base[slot] + rank[rows] - first[slot]
                offset[rows] = place[slot]
            keep = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(sequence), pa.array(offset)],
                                             names=[*keep, "sequence_id", "offset"])

    return run


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces."""
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    plan = slots(plan_bins(counts, capacity))
    ranked = pieces.join(offsets, ["length", "task"]).withColumn("rank", F.col("before") + F.col("rank_in_task"))
    names = [c for c in pieces.columns if c not in ("task", "rank_in_task")]
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes if n in names) + ", sequence_id bigint, offset bigint"
    return map_batches(ranked.select(*names, "rank"), _placer(plan), schema)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    return place(cut_pieces(docs, tokenizer, capacity, end_id, keep_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences of ``pack(..., keep_ids=True)``: sequence_id, length, doc_ids, ids (binary).

    A group holds at most ``capacity`` ids, so collecting it is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.col("parts.doc_id").alias("doc_ids"),
        F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
