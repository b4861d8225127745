"""Exact deduplication by Grace hashing.

1. Each task drops repeats of a text within its own rows, so that a text held by a third
   of all rows leaves at most a few rows per task.
2. Spark's shuffle deals the remaining texts out by a 64-bit hash of the whole text: the first partition level.
3. A task reads its partition into memory up to ``BUCKET_BYTES``.  Beyond that it
   writes the records to spill files by further bits of the hash, and treats each
   file the same way with the next bits, until a bucket fits.  Files are in
   Spark's own local spill folders, read by the task that wrote them only, and removed with it.
4. A bucket that fits goes into an open-addressing table: linear probing on
   the hash, complete texts compared on every occupied slot.
5. Groups of two or more go back to the member rows by digest; other rows keep themselves.

Two different texts with one SHA-256 would make step 5 ambiguous; the table compares whole
texts, so this is noticed and the job fails rather than drop a text.

Edge cases: null text counts as empty; a null doc_id ranks below every other; rows that repeat doc_id and text
belong to one group and share its decision, with their number in kept_rows, and ``drop_copies`` leaves one of
them; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import random
import shutil
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, save

BUCKET_BYTES = 48 << 20
FAN_OUT = 16
_BITS = 4  # of the hash, for each level of FAN_OUT files
_RECORD_COST = 160  # Python objects of a record beside its text
_HEAD = struct.Struct("<QqqqI32s")

#: hash, largest doc_id (None: no id), rows, rows with that doc_id, text, digest
Record = tuple[int, int | None, int, int, bytes, bytes]


class TextTable:
    """Open addressing with linear probing over complete texts."""

    def __init__(self, slots: int = 1024):
        self._slots: list[Record | None] = [None] * slots
        self.rows = 0
        self.bytes = 0

    def add(self, record: Record) -> bool:
        """Merge with the record of the same text or store it; True when stored."""
        key, doc_id, number, ties, text, digest = record
        slots = self._slots
        mask = len(slots) - 1
        at = (key ^ key >> 32) & mask
        while (held := slots[at]) is not None:
            if held[0] == key and held[4] == text:
                if held[1] == doc_id:
                    ties += held[3]
                elif doc_id is None or (held[1] is not None and held[1] > doc_id):
                    doc_id, ties = held[1], held[3]
                slots[at] = (key, doc_id, held[2] + number, ties, text, digest)
                return False
            if held[5] == digest:
                raise ValueError("two different texts share one SHA-256 digest")
            at = (at + 1) & mask
        slots[at] = record
        self.rows += 1
        self.bytes += len(text) + _RECORD_COST
        if 2 * self.rows > len(slots):
            self._grow()
        return True

    def _grow(self) -> None:
        old, self._slots = self._slots, [None] * (2 * len(self._slots))
        mask = len(self._slots) - 1
        for record in old:
            if record is not None:
                at = (record[0] ^ record[0] >> 32) & mask
                while self._slots[at] is not None:
                    at = (at + 1) & mask
                self._slots[at] = record

    def __iter__(self) -> Iterator[Record]:
        return (r for r in self._slots if r is not None)


class _SpillFile:
    def __init__(self, path: str):
        self.path = path
        self._out = open(path, "wb")

    def write(self, record: Record) -> None:
        key, doc_id, number, ties, text, digest = record
        low = doc_id is None
        self._out.write(_HEAD.pack(key, 0 if low else doc_id, -number if low else number, ties, len(text), digest))
        self._out.write(text)

    def read(self) -> Iterator[Record]:
        self._out.close()
        with open(self.path, "rb") as source:
            while head := source.read(_HEAD.size):
                key, doc_id, number, ties, size, digest = _HEAD.unpack(head)
                yield key, None if number < 0 else doc_id, abs(number), ties, source.read(size), digest
        os.remove(self.path)


def _spill_folder() -> str:
    """A folder in the directories Spark gives its workers for spilling."""
    local = os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")
    base = random.choice(local)
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix="grace-", dir=base)


def grace(records: Iterable[Record], bucket_bytes: int = BUCKET_BYTES, level: int = 0, folder: str | None = None) -> Iterator[Record]:
    """Merged records, one per text, in memory bounded by ``bucket_bytes`` and one record."""
    table, files = TextTable(), None
    own = None
    try:
        for record in records:
            if files is not None:
                files[record[0] >> (60 - _BITS * level) & (FAN_OUT - 1)].write(record)
                continue
            table.add(record)
            # the last level has used all bits of the hash: equal hashes stay in one table
            if table.bytes > bucket_bytes and table.rows > 1 and level < 64 // _BITS:
                if folder is None:
                    folder = own = _spill_folder()
                place = tempfile.mkdtemp(prefix=f"level-{level}-", dir=folder)
                files = [_SpillFile(f"{place}/{k:02d}") for k in range(FAN_OUT)]
                for held in table:
                    files[held[0] >> (60 - _BITS * level) & (FAN_OUT - 1)].write(held)
                table = TextTable()
        if files is None:
            yield from table
        else:
            for file in files:
                yield from grace(file.read(), bucket_bytes, level + 1, folder)
    finally:
        if own:
            shutil.rmtree(own, ignore_errors=True)


_SCHEMA = "hash long, keep_id long, group_size long, kept_rows long, text binary, digest binary"
_ARROW = [("hash", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("kept_rows", pa.int64()),
          ("text", pa.binary()), ("digest", pa.binary())]
_UNSIGNED = (1 << 64) - 1


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[Record]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            columns = [part.column(name).to_pylist() for name, _ in _ARROW]
            for key, *rest in zip(*columns):
                yield key & _UNSIGNED, *rest


def _batches(records: Iterable[Record], with_text: bool) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0

    def batch() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*rows)]
        columns[0] = [k - (1 << 64) if k >> 63 else k for k in columns[0]]
        fields = _ARROW if with_text else [f for f in _ARROW if f[0] != "text"]
        return pa.RecordBatch.from_arrays([pa.array(columns[i], t) for i, (n, t) in enumerate(_ARROW) if with_text or n != "text"],
                                          names=[n for n, _ in fields])

    for record in records:
        rows.append(record)
        held += len(record[4])
        if len(rows) >= 2048 or held > 4_000_000:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()


def _flushing(records: Iterable[Record], limit: int) -> Iterator[Record]:
    """Merge what meets within ``limit`` bytes; later repeats meet in the next level."""
    table = TextTable()
    for record in records:
        table.add(record)
        if table.bytes > limit:
            yield from table
            table = TextTable()
    yield from table


def groups(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per distinct text: digest (SHA-256), keep_id (largest doc_id), group_size, kept_rows (rows with that doc_id).

    ``docs`` needs doc_id, text and digest columns as ``_keyed`` makes them.
    """
    rows = docs.select(F.xxhash64("text").alias("hash"), F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                       F.lit(1).cast("long").alias("kept_rows"), F.col("text").cast("binary").alias("text"), "digest")
    half = bucket_bytes // 2
    local = map_batches(rows, lambda batches: _batches(_flushing(_records(batches), half), True), _SCHEMA)
    dealt = local.repartition("hash")
    merged = map_batches(dealt, lambda batches: _batches(grace(_records(batches), bucket_bytes), False), _SCHEMA.replace("text binary, ", ""))
    return merged.select("digest", "keep_id", "group_size", "kept_rows")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))


def find_copies(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, kept_rows."""
    keyed = _keyed(docs)
    several = groups(keyed, bucket_bytes).where("group_size > 1")
    found = keyed.select("doc_id", "digest").join(several, "digest", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    one = F.lit(1).cast("long")
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", one).alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
                        F.coalesce("kept_rows", one).alias("kept_rows"))


def drop_copies(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row of each text: the one with the largest doc_id, with all its columns."""
    found = save(find_copies(docs, bucket_bytes).where("not kept or kept_rows > 1")
                 .select(F.col("doc_id").alias("found_id"), F.unhex("text_sha256").alias("found_digest"), "kept"), "copies")
    digest = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256))

    def same(rows: DataFrame):
        return docs["doc_id"].cast("long").eqNullSafe(rows["found_id"]) & (digest == rows["found_digest"])

    # one plan at every size: the rows to drop grow with the input, so they are never sent to all tasks
    once = docs.join(found.hint("merge"), same(found), "left_anti")
    repeated = found.where("kept")
    if repeated.limit(1).count() == 0:
        return once
    return once.union(docs.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))
