"""Best-fit packing of tokenized documents into fixed-length sequences, by sum of squares.

Documents longer than a sequence are cut into full pieces and a last shorter one; nothing
else is cut.  Pieces are dealt by a hash of their identity into shards of bounded expected
size, and every shard is packed on its own, longest pieces first: with N(g) the number of
open bins that have g free tokens, a piece goes to the open bin that makes the sum of
N(g)**2 smallest (ties: the smallest gap), and opens a bin when no open one has room.  Only
lengths and digests travel; token ids stay with the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.tokens import encoder

#: Documents per packing shard; a shard is packed by one task and wastes a few bins at most.
SHARD_DOCS = 16_384


def token_pieces(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every text's pieces of at most ``capacity`` ids.

    A null or empty text is one piece that holds the end id.  Repeated rows give repeated pieces.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_file)
        for batch in batches:
            ids, offsets = coder.encode(batch.column(1), end_id)
            raw, size = memoryview(ids.view(np.uint8)), np.diff(offsets)
            n_pieces = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), n_pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            low = offsets[:-1][row] + start
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(low.tolist(), (low + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item, packed in the order given (``0 < length <= capacity``)."""
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n_bins = 0
    for i, size in enumerate(lengths.tolist()):
        gap = capacity
        if size < capacity:
            # change of the sum: bins with gap g lose one, bins with gap g - size gain one (a full bin is not counted)
            change = 2 * (count[:capacity + 1 - size] - count[size:])
            change[0] = -2 * count[size] - 1
            change[count[size:] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            if count[size + best]:
                gap = size + best
        if gap == capacity:
            b, n_bins = n_bins, n_bins + 1
        else:
            b = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > size:
            open_bins[gap - size].append(b)
            count[gap - size] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int, n_docs: int, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``n_docs`` sets the number of shards."""
    shards = max(1, -(-n_docs // shard_docs))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                                kind="stable", na_position="first")
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        shard = int(rows["_shard"].iloc[0])
        return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "piece": rows["piece"], "start": rows["start"],
                             "length": rows["length"], "ids_crc32": rows["ids_crc32"],
                             "sequence_id": (np.int64(shard) << np.int64(32)) + bins, "offset": offsets})

    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("int"))
    return dealt.groupBy("_shard").applyInPandas(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int = 1, capacity: int = 4096,
                   shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Tokenize whole texts and pack them into sequences of at most ``capacity`` ids.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: offsets in a
    sequence are gapless from 0.  Null and empty texts hold the end id alone; rows with a null
    ``doc_id`` and repeated rows are packed like any other; an empty table gives no rows; other
    columns are not read.
    """
    pieces = token_pieces(docs, tokenizer_file, end_id, capacity)
    return pack(pieces, capacity, docs.count(), shard_docs)
