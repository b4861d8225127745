import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import packing, retrieval_packing as rp
from tidemark.llm.tokens import tokenizer_path
from tests.llm.conftest import hostile_rows


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(rp.TOKENIZER))
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def test_word_encoder_equals_whole_texts():
    texts = [r[1] or "" for r in hostile_rows()] + [" a", "don't 'Tis x's", "é ́e", "ΟΔΟΣ ὈΔΟΣ. İstanbul", "x\r\ny\x0bz\x0cw v\u0085u", "a\x1cb", "12 3½ ²",
                                                    "<|startoftext|> a<|endoftext|>b", "가 ᅡ", "ﬁ ﬃ", "…—'ll", "ªº ¹²³¼½¾ Éa_b__ Ǆ ŉ ſ ß ẞ", "a_b ,'s 'RE 'Ll x'D", "End. end! A a1 x' b' c\x7f d\x01 'S e's.", "año\u00a0nuevo\u200bx", "\x00\x7f\xad a\u0301 İi"]
    for memo in (3, 1_000):
        encoder = rp.WordEncoder(tokenizer_path(rp.TOKENIZER), memo)
        for _ in range(2):
            got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]
            assert got == [x[:-1] for x in whole_ids(texts)]
        assert len(encoder._memo) <= memo


def check(rows, documents, capacity):
    """Every id in one piece, sequences gapless and within the capacity; returns the padding."""
    spans, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for doc_id, ids in documents:
        want[doc_id].append(ids)
    assert set(spans) == set(want)
    for doc_id, copies in want.items():
        if len(copies) > 1:  # repeated ids: as many pieces as tokens say
            assert sum(s[1] for s in spans[doc_id]) == sum(map(len, copies))
            continue
        at, ids = 0, copies[0]
        for start, length, crc, total in sorted(spans[doc_id]):
            assert start == at and total == len(ids)
            assert crc == zlib.crc32(np.array(ids[start: start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_every_id_once_without_padding(hostile):
    source = hostile_rows()
    documents = list(zip((r[0] for r in source), whole_ids([r[1] for r in source])))
    for capacity, shard_rows in ((2048, 4096), (64, 5)):
        packed = rp.pack(hostile, capacity=capacity, shard_rows=shard_rows, keep_ids=True)
        rows = packed.collect()
        assert check(rows, documents, capacity) == 0
        whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
        by_id = defaultdict(list)
        for r in rows:
            by_id[r.sequence_id].append((r.offset, bytes(r.ids)))
        assert whole == {k: b"".join(x for _, x in sorted(v)) for k, v in by_id.items()}


def test_empty(nothing):
    assert rp.pack(nothing).collect() == []


def topics(number, seed=3):
    rng = random.Random(seed)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(12)] for _ in range(6)]
    return [(d, " ".join(rng.choice(words[d % 6]) if rng.random() < 0.7 else rng.choice(["the", "of", "and", "a", "to", "in"]) for _ in range(rng.randint(5, 60))))
            for d in range(number)]


def brute_windows(items, held, number, mean, capacity):
    """Windows of one shard by plain BM25 over dictionaries: lists of (doc, first id, ids)."""
    def idf(t):
        return max(0.0, math.log((number - held[t] + 0.5) / (held[t] + 0.5)))

    def score(query, ids):
        tf = Counter(ids)
        return sum(idf(t) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(ids) / mean)) for t in sorted(query) if t in tf and idf(t) > 0)

    unused, rest, windows = list(range(len(items))), None, []
    while unused or rest:
        doc, at = rest or (unused.pop(0), 0)
        query = set(items[doc][1])
        window, rest = [(doc, at, min(capacity, len(items[doc][1]) - at))], None
        for d in sorted(unused, key=lambda d: (-round(score(query, items[d][1]), 9), d)):
            room = capacity - sum(n for _, _, n in window)
            if not room:
                break
            unused.remove(d)
            n = min(room, len(items[d][1]))
            window.append((d, 0, n))
            if n < len(items[d][1]):
                rest = (d, n)
        windows.append([(items[d][0], a, n) for d, a, n in window])
    return windows


def test_windows_are_the_seeds_bm25_neighbours():
    documents = topics(90)
    ids = whole_ids([t for _, t in documents])
    capacity, dtype = 256, np.dtype("<u2")
    held = Counter(t for i in ids for t in set(i))
    mean = sum(map(len, ids)) / len(ids)
    counts = np.array([held[t] for t in range(49_408)], float)
    packer = rp.Packer(rp.inverse_frequencies(counts, len(ids)), mean, dtype, capacity, 0)
    items = [{"doc_id": d, "start": 0, "length": len(i), "ids": np.array(i, dtype).tobytes()} for (d, _), i in zip(documents, ids)]
    got = defaultdict(list)
    for item, at, size, sequence, _ in packer.shard(items):
        got[sequence].append((item["doc_id"], at, size))
    want = brute_windows([(d, i) for (d, _), i in zip(documents, ids)], held, len(ids), mean, capacity)
    assert list(got.values()) == [w for w in want if sum(n for _, _, n in w) == capacity]
    assert [(i["doc_id"], a, n) for i, a, n in packer.open] == (want[-1] if sum(n for _, _, n in want[-1]) < capacity else [])


def test_index_drops_used_items_without_changing_scores():
    ids = [np.array(i, "<u2").tobytes() for i in whole_ids([t for _, t in topics(40)])]
    held = np.zeros(49_408)
    np.add.at(held, rp.terms_of(ids, np.dtype("<u2"), 49_408)[1], 1)
    index = rp.Index(ids, np.dtype("<u2"), rp.inverse_frequencies(held, 40), 50.0)
    query = np.unique(np.frombuffer(ids[7], "<u2")).astype(np.int64)
    before, left = index.scores(query), np.arange(40) % 3 == 0
    index.keep(left)
    assert np.allclose(index.scores(query), before[left], rtol=1e-12)


def test_windows_hold_like_documents(spark):
    """Neighbours in a window share a topic far more often than chance (one in six)."""
    documents = topics(600)
    docs = spark.createDataFrame([(d, t) for d, t in documents], "doc_id long, text string")
    rows = rp.pack(docs, capacity=512, shard_rows=200).collect()
    assert check(rows, list(zip((d for d, _ in documents), whole_ids([t for _, t in documents]))), 512) == 0
    windows = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.offset):
        windows[r.sequence_id].append(r.doc_id % 6)
    pairs = [(a, b) for w in windows.values() for a, b in zip(w, w[1:])]
    assert sum(a == b for a, b in pairs) > 0.6 * len(pairs)


def test_letters_and_signs_need_no_pattern(monkeypatch):
    encoder = rp.WordEncoder(tokenizer_path(rp.TOKENIZER), 100)
    monkeypatch.setattr(encoder, "_pieces", lambda text: [text] if len(text) == 1 else 1 / 0)
    texts = ["Éàñ oiseaux, Straße Plain. ŉ"]
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [x[:-1] for x in whole_ids(texts)]


def test_a_batch_asks_for_a_chunk_once_and_a_worker_keeps_lower_cased_pieces(monkeypatch):
    words = ["alpha", "beta", "na\u00efve", "gamma"]
    texts = [" ".join(w + s for x in words for w in (x, x.title(), x.upper()) for s in ("", ",", ".")) + "\n\n \t\u4e2d\u6587 \u4e2d\u6587"] * 5 + ["", " "]
    for memo, calls_of_a_word in ((0, 9), (100, 1)):
        encoder, calls = rp.WordEncoder(tokenizer_path(rp.TOKENIZER), memo), Counter()
        merge = encoder._merge
        monkeypatch.setattr(encoder, "_merge", lambda piece: calls.update([piece]) or merge(piece))
        assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [x[:-1] for x in whole_ids(texts)]
        assert all(calls[w] <= calls_of_a_word for w in words)
        assert len(encoder._memo) <= min(memo, len(words) + 3)


def test_words_before_runs_of_signs_need_no_pattern(monkeypatch):
    encoder = rp.WordEncoder(tokenizer_path(rp.TOKENIZER), 100)
    monkeypatch.setattr(encoder, "_pieces", lambda text: 1 / 0)
    texts = ["\u00c9t\u00e9, na\u00efve.\" plain''. x' A_ \u00c5b...)"]
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == [x[:-1] for x in whole_ids(texts)]
