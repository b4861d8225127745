"""Subword ids of whole texts, with a per-worker memo of chunks.

The byte-level BPE encodes each piece of its split pattern on its own, and in
a text whose white space is single spaces and single line feeds a new piece
starts before every space and at every line feed.  Such texts are cut there by
Arrow, a batch at a time; each distinct chunk of a batch is looked up once, words
are encoded once per worker (up to ``MEMO`` of them), and the ids are gathered by
numpy as little-endian unsigned 32-bit values.  Any other text is encoded
in one call.  Both ways give the ids of ``Tokenizer.encode`` on the whole text.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Words kept by a worker; others are encoded again.  About 300 bytes each.
MEMO = 200_000

_OTHER_SPACE = re.compile(r"[^\S \n]")
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others are numbered from 256 in byte order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _cut(texts: list[str | None]) -> pa.ListArray:
    """Chunks of the texts, after an empty one for each.

    A chunk that begins with a line feed stands for itself, any other one for
    a space and the chunk.  A text is read as if a line feed stood before it.
    An empty chunk, or a line feed alone, shows white space that forbids cutting.
    """
    begun = pa.array(["\n" + (t or "") for t in texts], pa.large_string())
    return pc.split_pattern(pc.replace_substring(begun, "\n", " \n"), " ")


def gather(parts: list[bytes], at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of parts ``at`` one after another, and where each part's begin, the end of all last."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // width
    number = sizes[at]
    place = np.concatenate(([0], np.cumsum(number)))
    rows = np.repeat((np.cumsum(sizes) - sizes)[at] - place[:-1], number)
    rows += np.arange(len(rows))
    return np.frombuffer(b"".join(parts), f"<u{width}")[rows], place


class Memo(dict):
    """Ids by chunk, made when they are asked for; the first ``limit`` ones are kept."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, chunk: str) -> bytes:
        ids = self._make(chunk)
        if len(self) < self._limit:
            self[chunk] = ids
        return ids


class ChunkEncoder:
    def __init__(self, path: str, memo: int = MEMO):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self._model = self._whole.model
        self._letters = byte_letters()
        self._space = self._letters[32]
        self._bytes = [_pack([i]) for i in range(1 + max(self._whole.get_vocab().values()))]
        self._feed = self._encode("\n")
        self._runs = Memo(self._encode, min(memo, 1_000))  # of signs after letters, or none
        self._memo = Memo(self._word, memo)  # of letters after a space
        self._first = Memo(lambda word: self._merge("", word), min(memo, 20_000))  # of letters after a line feed
        self._others = Memo(lambda chunk: self._encode(chunk if chunk[0] == "\n" else " " + chunk), min(memo, 20_000))

    def _encode(self, text: str) -> bytes:
        return _pack(self._whole.encode(text, add_special_tokens=False).ids)

    def _merge(self, space: str, word: str) -> bytes:
        """Letters, after a space or nothing: one piece, so the merges apply to it directly."""
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        ids = self._bytes
        return b"".join([ids[t.id] for t in self._model.tokenize(space + shown)])

    def _word(self, word: str) -> bytes:
        return self._merge(self._space, word)

    def _chunk(self, chunk: str) -> bytes | None:
        """Ids of a chunk; none where other white space asks for its whole text."""
        if chunk.isalpha():
            return self._memo[chunk]
        word = chunk.rstrip(SIGNS)
        signs = chunk[len(word):]
        if signs[:1] != "'":  # it may begin a piece with letters
            if word.isalpha():
                return self._memo[word] + self._runs[signs]
            if word[:1] == "\n" and word[1:].isalpha():  # the line feed is a piece of its own
                return self._feed + self._first[word[1:]] + self._runs[signs]
        return None if _OTHER_SPACE.search(chunk) else self._others[chunk]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (null: none) as little-endian unsigned 32-bit values."""
        cut = _cut(texts)
        start = cut.offsets.to_numpy()
        text = np.repeat(np.arange(len(texts)), np.diff(start))
        chunks = cut.values.dictionary_encode()
        at, chunks = chunks.indices.to_numpy(), chunks.dictionary
        whole = np.zeros(len(texts), bool)
        odd = pc.is_in(chunks, pa.array(["", "\n"], chunks.type)).to_numpy(zero_copy_only=False)[at]
        odd[start[:-1]] = False
        whole[text[odd]] = True
        needed = np.zeros(len(chunks), bool)  # by a text that is cut
        needed[at[~whole[text]]] = True
        ids = [self._chunk(c) if c and n else b"" for c, n in zip(chunks.to_numpy(zero_copy_only=False).tolist(), needed.tolist())]
        if None in ids:
            whole[text[np.array([i is None for i in ids])[at]]] = True
            ids = [i or b"" for i in ids]
        ids, place = gather(ids, at, 4)
        place, ids = 4 * place[start], memoryview(ids).cast("B")
        return [self._encode(t) if w and t else bytes(ids[a + 4: b])  # without the line feed before the text
                for t, w, a, b in zip(texts, whole.tolist(), place[:-1].tolist(), place[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(path: str, memo: int = MEMO) -> ChunkEncoder:
    """One encoder, and so one memo, per Python worker."""
    return ChunkEncoder(path, memo)
