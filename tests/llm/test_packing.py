import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import packing as pk
from tidemark.llm.common import map_batches
from tidemark.llm.tokens import ChunkEncoder, tokenizer_path
from tests.llm.conftest import hostile_rows


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_chunk_encoder_equals_whole_texts():
    texts = [r[1] for r in hostile_rows()] + ["", " a", "a ", "a  b", "a \nb", "\n\na", "a\n", "don't 'tis x's", "it's", "a,'s b", "x\r\ny\r\nz", "a\u2003b c",
                                              "1st 2nd, (a) [b]", "foo_bar. baz_", "a\x1cb c\x1c d", "\nfoo", "a'b'c' d'", "١٢ x²y", "éa b́.", "foo. bar.\nBaz, qux!"]
    for memo in (4, 1_000):
        encoder = ChunkEncoder(tokenizer_path(), memo)
        for _ in range(2):
            got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
            assert got == [x[:-1] for x in whole_ids(texts)]
        assert len(encoder._memo) <= max(memo, 4) + 3


def check(rows, want, capacity):
    pieces, sequences = Counter(), defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    expect = Counter()
    for doc_id, ids in want:
        start = 0
        for k, n in enumerate(pk.cut_lengths(len(ids), capacity)):
            expect[(doc_id, k, start, n, zlib.crc32(np.array(ids[start: start + n], "<u4").tobytes()))] += 1
            start += n
    assert pieces == expect
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_places_match_brute_force(hostile):
    source = hostile_rows()
    want = list(zip((r[0] for r in source), whole_ids([r[1] for r in source])))
    for capacity in (1024, 64):
        packed = pk.pack(hostile, capacity=capacity, keep_ids=True)
        rows = packed.collect()
        number = check(rows, want, capacity)
        assert number <= -(-sum(len(i) for _, i in want) // capacity) * 1.2 + 2
        whole = pk.sequences(packed).collect()
        by_id = defaultdict(list)
        for r in rows:
            by_id[r.sequence_id].append((r.offset, bytes(r.ids)))
        assert {r.sequence_id: bytes(r.ids) for r in whole} == {k: b"".join(x for _, x in sorted(v)) for k, v in by_id.items()}


def test_empty(nothing):
    assert pk.pack(nothing).collect() == []


def test_plan_uses_every_piece_once_and_packs_tightly():
    rng = random.Random(1)
    for capacity in (12, 100, 1024):
        counts = {s: rng.randint(0, 50) for s in range(1, capacity + 1)}
        bins = pk.plan_bins(counts, capacity)
        used = Counter()
        for pattern, number in bins:
            assert sum(pattern) <= capacity and number > 0
            assert sum(3 * s > capacity for s in pattern) <= 2
            for s in pattern:
                used[s] += number
        assert used == Counter({s: n for s, n in counts.items() if n})
        least = -(-sum(s * n for s, n in counts.items()) // capacity)
        assert sum(n for _, n in bins) <= max(least, sum(n for s, n in counts.items() if 2 * s > capacity)) * 1.03 + 2


def test_large_items_are_matched_best():
    assert sorted(pk.plan_bins({60: 2, 40: 2, 50: 3}, 100)) == [((50,), 1), ((50, 50), 1), ((60, 40), 2)]


def test_a_worker_keeps_few_chunks(monkeypatch):
    encoder = ChunkEncoder(tokenizer_path())
    monkeypatch.setattr(encoder, "_word", lambda word: b"\0\0\0\0")
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(letters[k // 26 ** i % 26] for i in range(5)) for k in range(300_000)]
    assert len(encoder.encode([" ".join(words)])[0]) >= 4 * (len(words) - 1)
    assert len(encoder._memo) <= 200_000  # about 300 bytes each, in every worker of an executor


def test_words_after_line_feeds_and_before_signs_need_no_whole_encoding(monkeypatch):
    """Most chunks that no worker has met are words with a line feed before or signs after them."""
    letters = "aeiounrstl\u00e9\u4e00"
    words = ["".join(letters[k // 12 ** i % 12] for i in range(4)) for k in range(500)]
    texts = ["\n".join(words), " ".join(w + "!!" for w in words), "x\n" + ".\n".join(words) + ")", "\n".join(w + "'s" for w in words[:9])]
    encoder, calls = ChunkEncoder(tokenizer_path(), 100), []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda text: calls.append(text) or encode(text))
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [x[:-1] for x in whole_ids(texts)]
    assert len(calls) < 20


def test_a_batch_asks_for_a_chunk_once_and_a_worker_keeps_words_without_signs(monkeypatch):
    words = ["alpha", "beta", "na\u00efve", "gamma"]
    texts = [" ".join(w + s for w in words for s in ("", ",", ".", "!!")) + "\nEnd of it"] * 5 + ["a  b", None, "x\u2003y alpha", ""]
    for memo, calls_of_a_word in ((0, 4), (100, 1)):
        encoder, calls = ChunkEncoder(tokenizer_path(), memo), Counter()
        word = encoder._merge
        monkeypatch.setattr(encoder, "_merge", lambda space, w: calls.update([w] if space else []) or word(space, w))
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [x[:-1] for x in whole_ids(texts)]
        assert all(calls[w] <= calls_of_a_word for w in words)
        assert len(encoder._memo) <= min(memo, len(words) + 2)


def test_a_worker_gets_few_text_bytes_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    texts = spark.range(0, 8_000, 1, 1).select(F.repeat(F.lit("word "), 500).alias("text"))
    rows = map_batches(texts, sizes, "n long, bytes long").collect()
    assert sum(r.n for r in rows) == 8_000 and max(r.bytes for r in rows) < 5_000_000
