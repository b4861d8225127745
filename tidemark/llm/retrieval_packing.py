"""Lexical retrieval packing: windows filled with the BM25 neighbours of a seed document.

1. *Ids.*  Each text becomes ids closed by an end id.  Full windows of a longer document are sequences of
   their own; what is left (shorter than a window) is one *item*.  The same pass counts in how many items each
   token occurs and gives every item an order key: three weighted min-hashes of its tokens, so items with
   the same telling words stand together.
2. *Shards.*  Items are ranged by (key, row id); a shard is a run of at most ``SHARD_ROWS`` of them in that order.
   The row id splits any number of equal texts over shards.
3. *Inverted index.*  A shard holds postings by token with BM25 weights, document frequencies and the mean length
   taken from all items.  A token's idf is 0 where more than half of the items hold it.
4. *Windows.*  The first unused item in order is the seed.  All its distinct tokens are looked up, weights are
   added up term at a time, and the unused items follow by score (ties and items without a common token: in order)
   until the window is full.  The last one is cut to fit, and its rest is the next seed.  A window still
   open when the shard is used up goes on with the next shard's index.

So every sequence is full but for one at the end of each range of shards.  That one is cut into sequences whose
lengths are powers of two, which need no padding.

Edge cases: null or empty text, and text of white space, is the end id alone (an item without tokens in common but the end
id, which has no weight); repeated rows are packed once per row; a null doc_id is carried along; an empty table gives
no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, shared, slices
from tidemark.llm.tokens import SIGNS, Memo, byte_letters, gather, tokenizer_path
from tidemark.session import shared_path

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_ROWS = 4096
K1, B = 1.2, 0.75
#: A token with at least one item in so many is added up as a dense row.
DENSE_PART = 16
#: Pieces and other chunks kept by a worker: about 60 MB; more of them cost more in memory and its misses than they save.
MEMO = 200_000
#: Min-hashes of the order key, 16 bits each.
KEY_PARTS = 3


# The vocabulary's split pattern on lower-cased text, fixed values; for ASCII, and for Latin letters where \p{N} adds six signs.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9\s]+", re.ASCII)
_LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[0-9²³¹¼½¾]|(?:[^\w\s]|_)+")
_ASCII_SPACE = re.compile(r"\s+", re.ASCII)
#: Four controls that only one of the two notions of white space holds.
_CONTROLS = re.compile("[\x1c-\x1f]")
#: These, and all beyond Latin.
_OTHER = re.compile("[^\0-\x1b\x20-\u024f]")


class WordEncoder:
    """Ids of whole texts, as little-endian 16-bit values, or 32-bit ones of a larger vocabulary.

    The vocabulary cuts a text in its lower-cased normal form into pieces that never reach over white space, and merges
    within each piece.  So texts are cut at white space, a batch at a time by Arrow where it is spaces and line feeds, and each
    distinct chunk of a batch is looked up once.  Latin chunks are cut into pieces here, and other chunks are
    encoded in a call each.  A worker keeps the ids of up to ``memo`` pieces, lower-cased, and other chunks.
    """

    def __init__(self, path: str, memo: int = MEMO):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._model = self._tokenizer.model
        self._letters = byte_letters()
        self.size = self._tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._bytes = [i.to_bytes(self.dtype.itemsize, "little") for i in range(self.size)]
        self._memo = Memo(self._ids, memo)

    def _pieces(self, text: str) -> list[str] | None:
        """Pieces of a Latin text; None where it holds anything else."""
        if text.isascii():
            return None if _OTHER.search(text) else _ASCII_PIECES.findall(text.lower())
        if _OTHER.search(text) or not unicodedata.is_normalized("NFC", text):
            return None
        return _LATIN_PIECES.findall(text.lower())

    def _merge(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self._letters)
        ids = self._bytes
        return b"".join([ids[t.id] for t in self._model.tokenize(shown)])

    def _ids(self, key: str) -> bytes:
        """Ids of a lower-cased piece of a Latin chunk, or of any other chunk."""
        if key.isascii() and key.isalpha() or not _OTHER.search(key):
            return self._merge(key)
        return np.array(self._tokenizer.encode(key, add_special_tokens=False).ids, self.dtype).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        lower = chunk.lower()
        word = lower if lower.isalpha() else lower.rstrip(SIGNS)
        if word.isalpha() and (chunk.isascii() or not _OTHER.search(chunk)):  # letters are one piece, and signs after them one more
            return self._memo[word] + self._memo[lower[len(word):]] if len(word) < len(lower) else self._memo[word]
        parts = _ASCII_SPACE.split(chunk) if _CONTROLS.search(chunk) else chunk.split()
        if parts != [chunk]:
            return b"".join(map(self._chunk, parts))
        pieces = self._pieces(chunk)
        return b"".join([self._memo[p] for p in pieces]) if pieces is not None else self._memo[chunk]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        chunks = cut.values.dictionary_encode()
        width = self.dtype.itemsize
        ids, place = gather(list(map(self._chunk, chunks.dictionary.to_numpy(zero_copy_only=False))), chunks.indices.to_numpy(), width)
        place, ids = (width * place[cut.offsets.to_numpy()]).tolist(), memoryview(ids).cast("B")
        return [bytes(ids[a:b]) for a, b in zip(place, place[1:])]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def terms_of(ids: list[bytes], dtype: np.dtype, size: int, step: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, token, count) of all items, sorted by item and token; a few items at a time, for the memory."""
    if len(ids) > step:
        parts = [terms_of(ids[at: at + step], dtype, size) for at in range(0, len(ids), step)]
        items = np.concatenate([p[0] + at for p, at in zip(parts, range(0, len(ids), step))])
        return items, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    lengths = np.array([len(i) for i in ids]) // dtype.itemsize
    tokens = np.frombuffer(b"".join(ids), dtype).astype(np.int64)
    pairs, counts = np.unique(np.repeat(np.arange(len(ids)), lengths) * size + tokens, return_counts=True)
    return pairs // size, pairs % size, counts


def crc(ids: bytes, dtype: np.dtype) -> int:
    return zlib.crc32(np.frombuffer(ids, dtype).astype("<u4").tobytes())


@lru_cache(maxsize=2)
def _key_hashes(size: int) -> np.ndarray:
    """Per key part and token: -ln of a fixed uniform number, over the token's weight.

    Merges found later stand for rarer strings, so the id itself tells how rare a token is.
    """
    uniform = np.random.default_rng(7).random((KEY_PARTS, size))
    return -np.log1p(-uniform) / np.log2(1.01 + np.arange(size) / 512)


def order_keys(items: np.ndarray, tokens: np.ndarray, counts: np.ndarray, rows: int, size: int) -> np.ndarray:
    """The order key of each item, none of which may lack tokens."""
    first = np.searchsorted(items, np.arange(rows))
    damped = counts / (counts + K1)
    keys = np.zeros(rows, np.int64)
    for hashes in _key_hashes(size):
        values = hashes[tokens] / damped
        least = np.minimum.reduceat(values, first)
        at = np.flatnonzero(values == least[items])
        _, winner = np.unique(items[at], return_index=True)
        keys = (keys << 16) | (tokens[at[winner]] & 0xFFFF)
    return keys


_ENCODED = pa.schema([("kind", pa.string()), ("row_id", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                      ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("ids", pa.binary()),
                      ("key", pa.int64()), ("token", pa.int64()), ("items", pa.int64())])
_ENCODED_DDL = ("kind string, row_id long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                "ids binary, key long, token long, items long")


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_ENCODED)


def _encode_batches(path: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        dtype, size = encoder.dtype, encoder.size
        end, width = np.array([end_id], dtype).tobytes(), dtype.itemsize
        held = np.zeros(size, np.int64)
        sequence = -1 - (TaskContext.get().partitionId() << 33)  # below zero: apart from the shards' numbers
        for batch in slices(batches, rows=1024):  # a chunk is looked up once in a slice
            texts = [t or "" for t in batch.column("text").to_pylist()]
            windows, items = [], []
            for row_id, doc_id, ids in zip(batch.column("row_id").to_pylist(), batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                ids += end
                total = len(ids) // width
                full = total - total % capacity
                for start in range(0, full, capacity):
                    part = ids[width * start: width * (start + capacity)]
                    windows.append({"kind": "window", "row_id": row_id, "doc_id": doc_id, "start": start, "length": capacity, "doc_tokens": total,
                                    "ids_crc32": crc(part, dtype), "sequence_id": sequence, "ids": part if keep_ids else None})
                    sequence -= 1
                if total > full:
                    items.append({"kind": "item", "row_id": row_id, "doc_id": doc_id, "start": full, "length": total - full, "doc_tokens": total,
                                  "ids": ids[width * full:]})
            if items:
                terms = terms_of([i["ids"] for i in items], dtype, size)
                held += np.bincount(terms[1], minlength=size)
                for item, key in zip(items, order_keys(*terms, len(items), size).tolist()):
                    item["key"] = key
            if windows or items:
                yield _batch(windows + items)
        seen = np.flatnonzero(held)
        if len(seen):
            yield _batch([{"kind": "token", "token": t, "items": n} for t, n in zip(seen.tolist(), held[seen].tolist())])

    return run


def encode_items(docs: DataFrame, path: str, capacity: int, end_id: int, keep_ids: bool) -> DataFrame:
    """Full windows, items and token counts per task (kinds window, item, token), written once, a folder each."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    target = shared_path(docs.sparkSession, "llm", "retrieval-items")
    encoded = map_batches(rows, _encode_batches(path, capacity, end_id, keep_ids), _ENCODED_DDL)
    encoded.write.partitionBy("kind").parquet(target)
    return docs.sparkSession.read.schema(encoded.schema).option("basePath", target).parquet(target)


def inverse_frequencies(held: np.ndarray, items: int) -> np.ndarray:
    return np.maximum(np.log((items - held + 0.5) / (held + 0.5)), 0.0)


class Index:
    """Postings of one shard by token, with BM25 weights."""

    def __init__(self, ids: list[bytes], dtype: np.dtype, idf: np.ndarray, mean_length: float):
        items, tokens, counts = terms_of(ids, dtype, len(idf))
        lengths = np.array([len(i) for i in ids]) / dtype.itemsize
        self._of_item, self._item_tokens = np.searchsorted(items, np.arange(len(ids) + 1)), tokens
        telling = idf[tokens] > 0
        items, tokens, counts = items[telling], tokens[telling], counts[telling]
        weights = idf[tokens] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * lengths[items] / mean_length))
        order = np.argsort(tokens, kind="stable")  # items ascend within a token
        self._items, self._weights, self._rows = items[order], weights[order], len(ids)
        self._arrange(tokens[order])

    def _arrange(self, tokens: np.ndarray) -> None:
        """Ranges of the postings by token; those of frequent tokens also as dense rows."""
        self._tokens, self._first = np.unique(tokens, return_index=True)
        self._end = np.append(self._first[1:], len(tokens)).astype(np.int64)
        frequent = np.flatnonzero((self._end - self._first) * DENSE_PART >= self._rows)
        self._dense = {}
        for at in frequent.tolist():
            row = np.zeros(self._rows)
            part = slice(self._first[at], self._end[at])
            row[self._items[part]] = self._weights[part]
            self._dense[at] = row

    def query(self, item: int) -> np.ndarray:
        """Distinct tokens of an item, by its number when the index was built."""
        return self._item_tokens[self._of_item[item]: self._of_item[item + 1]]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Added weights of every item for the distinct tokens of a query, term at a time."""
        at = np.searchsorted(self._tokens, query)
        inside = at < len(self._tokens)
        at = at[inside][self._tokens[at[inside]] == query[inside]].tolist()
        first, end, dense = self._first, self._end, self._dense
        parts = [slice(first[k], end[k]) for k in at if k not in dense]
        if parts:
            found = np.bincount(np.concatenate([self._items[p] for p in parts]), np.concatenate([self._weights[p] for p in parts]), self._rows)
        else:
            found = np.zeros(self._rows)
        for k in at:
            if k in dense:
                found += dense[k]
        return found

    def keep(self, items: np.ndarray) -> None:
        """Renumber to the items of a mask and drop the postings of all others."""
        left = items[self._items]
        token = np.repeat(self._tokens, self._end - self._first)[left]
        self._items = (np.cumsum(items) - 1)[self._items[left]]
        self._weights, self._rows = self._weights[left], int(items.sum())
        self._arrange(token)


def by_score(candidates: np.ndarray, scores: np.ndarray, first: int = 64) -> Iterator[int]:
    """Candidates from the highest score down, ties in order; the first few are found without sorting all."""
    if len(candidates) > 4 * first:
        least = np.partition(scores, len(scores) - first)[len(scores) - first]
        top = np.flatnonzero(scores >= least)
        yield from candidates[top[np.argsort(-scores[top], kind="stable")]].tolist()
        rest = scores < least
        candidates, scores = candidates[rest], scores[rest]
    yield from candidates[np.argsort(-scores, kind="stable")].tolist()


class Packer:
    """Fills windows shard by shard; what it yields are pieces (row, start, length, sequence, offset)."""

    def __init__(self, idf: np.ndarray, mean_length: float, dtype: np.dtype, capacity: int, sequence: int):
        self.idf, self.mean_length, self.dtype, self.capacity = idf, mean_length, dtype, capacity
        self.sequence = sequence
        self.open: list[tuple[dict, int, int]] = []  # (item, first id, ids) of the open window
        self.filled = 0
        self.query: np.ndarray | None = None

    def _put(self, item: dict, at: int) -> int:
        """Add what fits of an item from id ``at`` on; returns where it was cut, or its length."""
        size = min(item["length"] - at, self.capacity - self.filled)
        self.open.append((item, at, size))
        self.filled += size
        return at + size

    def _close(self) -> Iterator[tuple]:
        offset = 0
        for item, at, size in self.open:
            yield item, at, size, self.sequence, offset
            offset += size
        self.sequence += 1
        self.open, self.filled, self.query = [], 0, None

    def shard(self, items: list[dict]) -> Iterator[tuple]:
        index = Index([i["ids"] for i in items], self.dtype, self.idf, self.mean_length)
        for k, item in enumerate(items):
            item["number"] = k
        unused = np.ones(len(items), bool)  # of the items that the index holds
        left, next_seed = len(items), 0
        rest: tuple[dict, int] | None = None
        while left or rest:
            if self.query is None:
                if rest:
                    item, at = rest
                    rest = None
                else:
                    while not unused[next_seed]:
                        next_seed += 1
                    item, at = items[next_seed], 0
                    unused[next_seed] = False
                    left -= 1
                self.query = index.query(item["number"])
                self._put(item, at)
            if left and self.filled < self.capacity:
                if 4 * left < 3 * len(items):
                    index.keep(unused)
                    items = [i for i, keep in zip(items, unused.tolist()) if keep]
                    unused, next_seed = np.ones(left, bool), 0
                scores = index.scores(self.query)
                candidates = np.flatnonzero(unused)
                for row in by_score(candidates, scores[candidates]):
                    unused[row] = False
                    left -= 1
                    at = self._put(items[row], 0)
                    if at < items[row]["length"]:
                        rest = items[row], at
                    if self.filled == self.capacity:
                        break
            if self.filled < self.capacity:
                return  # no item is left: the window stays open
            yield from self._close()

    def finish(self) -> Iterator[tuple]:
        """The open window as sequences whose lengths are powers of two, longest first."""
        parts, total = self.open, self.filled
        while total:
            self.open, self.filled, size = [], 0, 1 << (total.bit_length() - 1)
            while self.filled < size:
                item, at, n = parts[0]
                take = min(n, size - self.filled)
                self.open.append((item, at, take))
                self.filled += take
                parts = ([(item, at + take, n - take)] if take < n else []) + parts[1:]
            total -= size
            yield from self._close()


_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def _pack_batches(statistics, dtype: np.dtype, capacity: int, shard_rows: int, keep_ids: bool):
    width = dtype.itemsize

    def rows(pieces) -> pa.RecordBatch:
        out = []
        for item, at, size, sequence, offset in pieces:
            part = item["ids"][width * at: width * (at + size)]
            out.append({"doc_id": item["doc_id"], "start": item["start"] + at, "length": size, "ids_crc32": crc(part, dtype),
                        "doc_tokens": item["doc_tokens"], "sequence_id": sequence, "offset": offset, "ids": part if keep_ids else None})
        return pa.RecordBatch.from_pylist(out, schema=_PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean_length = statistics.value
        packer = Packer(idf, mean_length, dtype, capacity, TaskContext.get().partitionId() << 33)
        held: list[dict] = []
        for batch in batches:
            for at in range(0, batch.num_rows, shard_rows):
                held += batch.slice(at, shard_rows).to_pylist()
                if len(held) >= shard_rows:
                    yield rows(packer.shard(held[:shard_rows]))
                    held = held[shard_rows:]
        if held:
            yield rows(packer.shard(held))
        yield rows(packer.finish())

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         shard_rows: int = SHARD_ROWS, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids (16-bit)].

    ``packing.sequences`` joins the ids of ``keep_ids=True`` into whole sequences.
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path(TOKENIZER)
    encoder = word_encoder(path)
    encoded = encode_items(docs, path, capacity, end_id, keep_ids)
    items = encoded.where("kind = 'item'")
    number, tokens = items.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    held = np.zeros(encoder.size)
    for token, n in encoded.where("kind = 'token'").groupBy("token").agg(F.sum("items")).collect():  # at most a row per id of the vocabulary
        held[token] = n
    statistics = inverse_frequencies(held, number), tokens / max(1, number)
    ranged = (items.select("key", "row_id", "doc_id", "start", "length", "doc_tokens", "ids")
              .repartitionByRange(max(1, -(-number // shard_rows)), "key", "row_id").sortWithinPartitions("key", "row_id"))
    target = shared_path(spark, "llm", "retrieval-packed")
    with shared(spark, statistics) as broadcast:  # eight bytes per id of the vocabulary
        map_batches(ranged, _pack_batches(broadcast, encoder.dtype, capacity, shard_rows, keep_ids), _PIECES_DDL).write.parquet(target)
    names = _PIECES.names if keep_ids else _PIECES.names[:-1]
    windows = encoded.where("kind = 'window'").withColumn("offset", F.lit(0).cast("long"))
    return spark.read.schema(_PIECES_DDL).parquet(target).select(*names).unionByName(windows.select(*names))
