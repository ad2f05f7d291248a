"""Token counts of whole texts with a public ``sentencepiece`` model; ids never leave the library call.

Arrow functions encode and return lengths only.  Rows of an Arrow batch, which is bounded by
bytes, are encoded in library batches of about ``BATCH_BYTES``, cut where the running sum of
bytes passes it, so that a call with a few long texts is as large as one with many short ones.

A text longer than ``PIECE_BYTES`` is cut into pieces of about that size at safe boundaries:
between two characters that stand side by side in no piece of the vocabulary, so that no merge
can join what lies on either side.  The library puts a space before every text:

* where a space follows the boundary, the piece is what comes after that space, and the space that the
  library adds stands for it;
* elsewhere the added space must not stand before the next character in any vocabulary piece, and counts
  as one token too many.

The pieces' counts then sum to the count of the whole text; a stretch without any safe
boundary stays in one piece, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import row_blocks, text_bytes

#: Bytes of one library call, and of a piece of a long text, aimed at.
BATCH_BYTES, PIECE_BYTES = 1 << 20, 1 << 16
#: How the model writes a space.
SPACE = "▁"


class Counter:
    """Counts tokens of whole texts; one per worker process and file."""

    def __init__(self, path: str, piece_bytes: int = PIECE_BYTES):
        self._library = sentencepiece.SentencePieceProcessor(model_file=path)
        self._piece = piece_bytes
        pieces = (self._library.id_to_piece(i) for i in range(self._library.get_piece_size()))
        self._joined = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}

    def _safe(self, text: str, at: int) -> bool:
        before, after = text[at - 1].replace(" ", SPACE), text[at].replace(" ", SPACE)
        if before + after in self._joined:
            return False
        return at + 1 < len(text) if text[at] == " " else SPACE + after not in self._joined

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The text cut at safe boundaries, and how many tokens too many the pieces have in total."""
        out, extra, start = [], 0, 0
        at = start + self._piece
        while at < len(text):
            if not self._safe(text, at):
                at += 1
                continue
            out.append(text[start:at])
            start = at + 1 if text[at] == " " else at
            extra += text[at] != " "
            at = start + self._piece
        return [*out, text[start:]], extra

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of every row of a text buffer."""
        raw, out = data.tobytes(), np.zeros(len(offsets) - 1, np.int64)
        for first, last in row_blocks(offsets, BATCH_BYTES):
            bounds = offsets[first:last + 1].tolist()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:])]
            if last - first == 1 and bounds[1] - bounds[0] > self._piece:
                out[first] = self._long(texts[0])
                continue
            row, batch = [], []
            for i, text in enumerate(texts):
                cut, extra = self.pieces(text) if bounds[i + 1] - bounds[i] > self._piece else ([text], 0)
                out[first + i] -= extra
                batch += cut
                row += [first + i] * len(cut)
            np.add.at(out, row, self._sizes(batch))
        return out

    def _long(self, text: str) -> int:
        """Tokens of one long text, its pieces dealt into library calls of bounded size."""
        cut, extra = self.pieces(text)
        step = max(1, BATCH_BYTES // self._piece)
        return sum(int(self._sizes(cut[i:i + step]).sum()) for i in range(0, len(cut), step)) - extra

    def _sizes(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(len, self._library.encode(texts, num_threads=1)), np.int64, len(texts))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker process's counter of this file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    ``n_tokens`` is the number of ids that the library gives for the whole text, without begin or end
    ids; ``over_limit`` tells whether it is above ``limit``.  A null or empty text has 0 bytes and 0 tokens.
    Every row gives one row, repeated rows and rows with a null ``doc_id`` included; an empty table gives none;
    other columns are not read.  The model must be one that the library does not normalise and that falls back
    to bytes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = counter(model_file)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            tokens = worker.counts(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
