"""Token ids in seekable files of independent zstandard frames.

Layout of a file (all numbers little-endian):

* data frames: the ids of all documents one after another as unsigned 32-bit
  values, cut after every ``frame_ids`` ids; each cut is a zstandard frame of its own;
* a skippable frame with the document table: per document its id (signed
  64-bit; a null id as the flag byte 1), its first id's place and its length;
* the seek table, a skippable frame in the public zstandard seekable format:
  compressed size, size and checksum (low 32 bits of XXH64) of each data
  frame, then frame count, descriptor and magic number.

Any zstandard tool can decompress a file, and a reader that wants some
documents reads the tail and then only the frames that hold them.

Documents are range-partitioned by doc_id and sorted within the tasks; task k
writes file k, under another name first, so a retried or doubled task leaves one whole file.

Edge cases: null or empty text is the end id alone; null doc_ids come first; rows that repeat
a doc_id are written one after another, ordered by text; an empty table gives no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, save, slices
from tidemark.llm.tokens import END_ID, encoder, tokenizer_path
from tidemark.session import shared_path

FRAME_IDS = 65_536
LEVEL = 3
#: Words kept by a worker, which holds little else than a batch and a frame.
MEMO = 400_000
# Fixed values of the zstandard seekable format.
SEEK_TABLE_FRAME = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
DOCUMENT_FRAME = 0x184D2A50  # a skippable frame free for own use

_ENTRY = struct.Struct("<III")
_FOOTER = struct.Struct("<IBI")
_DOCUMENT = np.dtype([("null", "u1"), ("doc_id", "<i8"), ("first", "<u8"), ("length", "<u8")])


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class TokenFileWriter:
    """Appends documents to one file; ``close`` writes the tables."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        import zstandard

        self._sink, self._bytes = sink, 4 * frame_ids
        self._compress = zstandard.ZstdCompressor(level=level).compress
        self._buffer = bytearray()
        self._frames: list[bytes] = []
        self._documents: list[tuple] = []
        self.ids = 0

    def _frame(self, data: bytes) -> None:
        packed = self._compress(data)
        self._sink.write(packed)
        self._frames.append(_ENTRY.pack(len(packed), len(data), _checksum(data)))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._documents.append((doc_id is None, doc_id or 0, self.ids, len(ids) // 4))
        self.ids += len(ids) // 4
        self._buffer += ids
        while len(self._buffer) >= self._bytes:
            self._frame(bytes(self._buffer[: self._bytes]))
            del self._buffer[: self._bytes]

    def close(self) -> None:
        if self._buffer:
            self._frame(bytes(self._buffer))
        documents = np.array(self._documents, _DOCUMENT).tobytes()
        self._sink.write(struct.pack("<II", DOCUMENT_FRAME, len(documents)) + documents)
        table = b"".join(self._frames) + _FOOTER.pack(len(self._frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._sink.write(struct.pack("<II", SEEK_TABLE_FRAME, len(table)) + table)


class TokenFileReader:
    """Reads documents of one file, decompressing only the frames asked for."""

    def __init__(self, source):
        import zstandard

        self._source = source
        self._decompress = zstandard.ZstdDecompressor().decompress
        size = source.size()
        number, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("not a token file: no seek table with checksums at its end")
        table = size - _FOOTER.size - number * _ENTRY.size
        entries = np.frombuffer(self._at(table, number * _ENTRY.size), "<u4").reshape(number, 3).astype(np.int64)
        self.sizes, self._sums = entries[:, 1], entries[:, 2]
        self._place = np.concatenate(([0], np.cumsum(entries[:, 0])))
        self._start = np.concatenate(([0], np.cumsum(entries[:, 1])))
        first = int(self._place[-1])
        magic, length = struct.unpack("<II", self._at(first, 8))
        if magic != DOCUMENT_FRAME:
            raise ValueError("not a token file: no document table")
        self.documents = np.frombuffer(self._at(first + 8, length), _DOCUMENT)
        self._last: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, length: int) -> bytes:
        self._source.seek(place)
        return self._source.read(length)

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            packed = self._at(int(self._place[k]), int(self._place[k + 1] - self._place[k]))
            data = self._decompress(packed, max_output_size=int(self.sizes[k]))
            if len(data) != self.sizes[k] or _checksum(data) != self._sums[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self._last = (k, data)
        return self._last[1]

    def parts(self, first: int, length: int) -> Iterator[bytes]:
        """The bytes of ``length`` ids from place ``first``, frame by frame."""
        at, end = 4 * first, 4 * (first + length)
        k = int(np.searchsorted(self._start, at, side="right")) - 1
        while at < end:
            stop = min(end, int(self._start[k + 1]))
            yield self.frame(k)[at - int(self._start[k]): stop - int(self._start[k])]
            at, k = stop, k + 1

    def read(self, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
        wanted = np.isin(self.documents["doc_id"], np.fromiter(doc_ids, np.int64)) & (self.documents["null"] == 0)
        return {int(d["doc_id"]): np.frombuffer(b"".join(self.parts(int(d["first"]), int(d["length"]))), "<u4")
                for d in self.documents[wanted]}


def _open(uri: str):
    """File system and path of a folder that all executors share (a plain path or a URI)."""
    return pafs.FileSystem.from_uri(uri)


def _writer(folder: str, path: str, frame_ids: int, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        encode, (system, base) = encoder(path, MEMO).encode, _open(folder)
        name, draft = f"part-{task:06d}.tokens.zst", f"{base}/.draft-{uuid.uuid4().hex}"
        writer = sink = None
        documents = 0
        for batch in slices(batches, rows=1024):  # a chunk is looked up once in a slice
            if writer is None:
                sink = system.open_output_stream(draft)
                writer = TokenFileWriter(sink, frame_ids)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                writer.add(doc_id, ids + end)
            documents += batch.num_rows
        if writer is None:
            return
        writer.close()
        sink.close()
        system.move(draft, f"{base}/{name}")
        yield pa.RecordBatch.from_pydict({"file": pa.array([task], pa.int32()), "path": [f"{folder}/{name}"],
                                          "documents": [documents], "ids": [writer.ids]})

    return run


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None,
                      frame_ids: int = FRAME_IDS, end_id: int = END_ID) -> DataFrame:
    """Write every document in ascending doc_id order; returns one row per file: file, path, documents, ids."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "llm", "token-files")
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    run = _writer(folder, tokenizer or tokenizer_path(), frame_ids, end_id)
    return save(map_batches(ordered, run, "file int, path string, documents long, ids long"), "token-manifest")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
            system, path = _open(uri)
            with system.open_input_file(path) as source:
                file = TokenFileReader(source)
                for at in range(0, len(file.documents), 4096):
                    part = file.documents[at: at + 4096]
                    sums = []
                    for first, length in zip(part["first"].tolist(), part["length"].tolist()):
                        crc = 0
                        for data in file.parts(first, length):
                            crc = zlib.crc32(data, crc)
                        sums.append(crc)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(part["doc_id"].astype(np.int64), mask=part["null"] == 1),
                        "start": pa.array(part["first"].astype(np.int64) + before),
                        "n_tokens": pa.array(part["length"].astype(np.int64)), "ids_crc32": pa.array(sums, pa.int64())})


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row per document, computed from the files: doc_id, start, n_tokens, ids_crc32."""
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    tasks = max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism))
    return map_batches(files.repartition(tasks), _reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
