"""Token ids of whole texts with a public ``tokenizers`` file.

A text is cut at byte positions where every supported file's pattern surely ends a
pre-token, so the ids of a text are the ids of its chunks in order (tests hold this against
encoding whole texts):

* before white space that follows a printable ASCII character or a two-byte UTF-8 character
  from U+00C0 on (neither is white space),
* between an ASCII letter and ASCII punctuation, either way round, except after an
  apostrophe (it may begin a contraction).

Blocks of rows in which the string of an added token occurs are encoded text by text.

A worker has the library encode each distinct chunk once and keeps the ids in a bounded memo
of arrays, keyed by the chunk's 64-bit hash; looking up and joining is numpy work on whole
blocks of rows.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ridgeline.llm.common import mix, prefix_hash, row_blocks, segment_hash, text_bytes

#: Distinct chunks that a worker keeps (about 40 bytes each); the memo starts anew beyond that.
MEMO_CHUNKS = 1 << 21

_SPACE, _LETTER, _PUNCT, _APOSTROPHE, _DIGIT, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _PUNCT
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[39] = _APOSTROPHE
_TWO_BYTE_LEAD = np.zeros(256, bool)
_TWO_BYTE_LEAD[0xC3:0xE0] = True


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted byte positions at which chunks start, row starts of non-empty rows included."""
    kind = _CLASS[data]
    cut = np.zeros(len(data), bool)
    solid = (kind > _SPACE) & (kind < _OTHER)
    solid[1:] |= _TWO_BYTE_LEAD[data[:-1]]
    letter, punct = kind == _LETTER, kind == _PUNCT
    cut[1:] = (solid[:-1] & (kind[1:] == _SPACE)) | (letter[:-1] & (punct | (kind == _APOSTROPHE))[1:]) | (punct[:-1] & letter[1:])
    starts = offsets[:-1][np.diff(offsets) > 0]
    cut[starts] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes rows of whole texts to ids; one per worker process and file."""

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content.lower().encode() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self._keys, self._at, self._size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids, self._used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, keys: np.ndarray, chunks: list[str]) -> None:
        coded = [c.ids for c in self._tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        total = int(size.sum())
        while self._used + total > len(self._ids):
            self._ids = np.concatenate((self._ids, np.zeros_like(self._ids)))
        self._ids[self._used:self._used + total] = np.fromiter((i for c in coded for i in c), np.uint32, total)
        at = self._used + np.cumsum(size) - size
        self._used += total
        where = np.searchsorted(self._keys, keys)
        self._keys = np.insert(self._keys, where, keys)
        self._at, self._size = np.insert(self._at, where, at), np.insert(self._size, where, size)

    def _whole_rows(self, raw: bytes, offsets: list[int]) -> tuple[np.ndarray, np.ndarray]:
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        coded = [c.ids for c in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = np.fromiter((i for c in coded for i in c), np.uint32, int(size.sum()))
        return ids, np.concatenate(([0], np.cumsum(size)))

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        if any(token in raw.lower() for token in self._added):
            return self._whole_rows(raw, offsets.tolist())
        starts = chunk_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        keys = mix(segment_hash(prefix_hash(data), starts, ends) + (ends - starts).astype(np.uint64))
        own, first, back = np.unique(keys, return_index=True, return_inverse=True)
        found = np.searchsorted(self._keys, own)
        known = np.zeros(len(own), bool)
        inside = found < len(self._keys)
        known[inside] = self._keys[found[inside]] == own[inside]
        if not known.all():
            if len(self._keys) + len(own) > MEMO_CHUNKS and len(self._keys):
                self._forget()
                known[:] = False
            new = ~known
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            self._learn(own[new], [raw[s:e].decode("utf-8", "replace") for s, e in spans])
            found = np.searchsorted(self._keys, own)
        size = self._size[found][back]
        to = np.cumsum(size)
        total = int(to[-1]) if len(to) else 0
        ids = self._ids[np.repeat(self._at[found][back] - (to - size), size) + np.arange(total)]
        chunk_of_row = np.searchsorted(starts, offsets)
        return ids, np.concatenate(([0], to))[chunk_of_row]

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, ``end_id`` after each row, as one uint32 array, and the n + 1 row offsets."""
        data, offsets = text_bytes(column)
        parts, at = [], [np.zeros(1, np.int64)]
        for first, last in row_blocks(offsets, 2 << 20):
            low, high = offsets[first], offsets[last]
            ids, rows = self._block(data[low:high], offsets[first:last + 1] - low)
            parts.append(np.insert(ids, rows[1:], np.uint32(end_id)))
            at.append(at[-1][-1] + rows[1:] + np.arange(1, len(rows)))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.concatenate(at)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker process's encoder of this file."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    """Path of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)
