"""Quality scores of documents: a linear SVM on Naive Bayes features.

Features are hashed indicators of word n-grams (one and two words) and of n-grams (one to
three) of word shapes: letter case, ending, length and whether the word repeats the one
before.  Each indicator is scaled by its log-count ratio between the classes, and a linear
hinge-loss model on them is fitted by dual coordinate descent; a logistic curve fitted on
rows set aside turns margins into probabilities.

The model is fitted by one task on at most about ``sample`` labelled documents a class,
chosen by a hash of their id; scoring reads every whole text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import BASE, mix, prefix_hash, row_blocks, segment_hash, text_bytes
from ridgeline.llm.svm import Rows, hinge_svm, platt, sigmoid

#: Hashed features: words and word pairs, then shapes.
WORD_BITS, SHAPE_BITS = 18, 14
COLUMNS = (1 << WORD_BITS) + (1 << SHAPE_BITS)
#: Bytes of text that are worked on at once (a longer text is one block).
BLOCK_BYTES = 1 << 18
#: Labelled documents a class that the model is fitted on, about.
SAMPLE = 4_000

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER, _LOWER, _DIGIT, _HIGH, _MARK = 1, 2, 4, 8, 16
_BIT = np.full(256, _MARK, np.uint8)
_BIT[65:91], _BIT[97:123], _BIT[48:58], _BIT[128:] = _UPPER, _LOWER, _DIGIT, _HIGH
_BIT[_SPACE] = 0  # white space after a word is no part of its shape


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every feature that a row has, each once, ordered by both."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = segment_hash(prefix_hash(data), start, end)
    bits = np.bitwise_or.reduceat(_BIT[data], start) if len(start) else np.zeros(0, np.uint8)
    again = np.zeros(len(start), bool)
    again[1:] = (row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])
    size = np.minimum((end - start) // 4, 7)
    shape = mix(bits.astype(np.uint64) | _BIT[data[start]].astype(np.uint64) << np.uint64(8)
                | np.minimum(data[end - 1], 128).astype(np.uint64) * (_BIT[data[end - 1]] == _MARK) << np.uint64(16)
                | again.astype(np.uint64) << np.uint64(32) | size.astype(np.uint64) << np.uint64(40))
    loose = mix(bits.astype(np.uint64) | again.astype(np.uint64) << np.uint64(32))
    columns, rows = [], []

    def add(row: np.ndarray, value: np.ndarray, bits: int, base: int) -> None:
        rows.append(row)
        columns.append((mix(value) >> np.uint64(64 - bits)).astype(np.int64) + base)

    base, two, three = 1 << WORD_BITS, np.uint64(BASE), np.uint64(BASE ^ 0xFFFF0000)
    pair = np.flatnonzero(row[1:] == row[:-1])
    triple = np.flatnonzero(row[2:] == row[:-2])
    add(row, hashes, WORD_BITS, 0)
    add(row[pair], hashes[pair] * two + hashes[pair + 1], WORD_BITS, 0)
    add(row, shape, SHAPE_BITS, base)
    add(row[pair], loose[pair] * two + loose[pair + 1], SHAPE_BITS, base)
    add(row[triple], (loose[triple] * two + loose[triple + 1]) * three + loose[triple + 2], SHAPE_BITS, base)
    key = np.unique(np.concatenate(rows) * COLUMNS + np.concatenate(columns))
    return key // COLUMNS, key % COLUMNS


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``label, share, fold, columns`` of ``label, share, fold, text``."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(3))
        for first, last in row_blocks(offsets, BLOCK_BYTES):
            low = offsets[first]
            row, column = features(data[low:offsets[last]], offsets[first:last + 1] - low)
            at = np.searchsorted(row, np.arange(last - first + 1))
            lists = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(column.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(first, last - first) for c in range(3)), lists],
                ["label", "share", "fold", "columns"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row ``model``: weights by column, bias and the curve."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(None)], pa.binary())], ["model"])
        return
    table = pa.Table.from_batches(parts).combine_chunks()
    label = np.where(table.column("label").to_numpy() > 0, 1.0, -1.0)
    weight = 1 / table.column("share").to_numpy()
    fold = table.column("fold").to_numpy()
    lists = table.column("columns").combine_chunks()
    column = lists.values.to_numpy()
    rows = Rows(lists.offsets.to_numpy().astype(np.int64), column, np.ones(len(column), np.float32))
    if (label > 0).all() or (label < 0).all():  # one class: its score is certain
        yield pa.RecordBatch.from_arrays(
            [pa.array([pickle.dumps((np.zeros(COLUMNS, np.float32), 0.0, 1.0, 8.0 * label[0]))], pa.binary())], ["model"])
        return
    learn, held = np.flatnonzero(fold != 0), np.flatnonzero(fold == 0)
    if len(held) < 20 or len(np.unique(label[held])) < 2 or len(np.unique(label[learn])) < 2:
        learn = held = np.arange(len(label))
    part = rows.take(learn)
    y = label[learn]
    size = np.diff(part.at)
    ups = np.bincount(part.column[np.repeat(y > 0, size)], minlength=COLUMNS) + 1.0
    downs = np.bincount(part.column[np.repeat(y < 0, size)], minlength=COLUMNS) + 1.0
    ratio = np.log(ups / ups.sum()) - np.log(downs / downs.sum())
    # rows have unit length, so long texts do not outweigh short ones
    part.value = _unit(part, ratio)
    cost = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    weights = hinge_svm(part, y, COLUMNS, cost)
    check = rows.take(held)
    check.value = _unit(check, ratio)
    margin = check.dot(weights) + weights[-1]
    a, b = platt(margin, label[held], weight[held])
    yield pa.RecordBatch.from_arrays(
        [pa.array([pickle.dumps((weights[:-1].astype(np.float32), ratio.astype(np.float32), weights[-1], a, b))], pa.binary())], ["model"])


def _unit(rows: Rows, ratio: np.ndarray) -> np.ndarray:
    scaled = ratio[rows.column].astype(np.float32)
    total = np.concatenate(([0.0], np.cumsum(scaled ** 2, dtype=np.float64)))
    norm = np.sqrt(np.maximum(total[rows.at[1:]] - total[rows.at[:-1]], 1e-12))
    return scaled / np.repeat(norm, np.diff(rows.at)).astype(np.float32)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 0) -> bytes:
    """Fit on ``docs`` joined with ``labels`` (``doc_id, label`` of 0 or 1); returns the model.

    Labels that are null or for no document are not used; of several labels of one document
    the smallest counts.
    """
    rows = (labels.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id"))
            .agg(F.min("label").cast("int").alias("label")))
    counts = rows.groupBy("label").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(1 << 30)) / float(1 << 30)
    # bounded by sample rows a class, about
    chosen = rows.join(F.broadcast(counts), "label").where(draw < F.col("share")).withColumn(
        "fold", F.pmod(F.xxhash64(F.lit(seed + 1), "_id"), F.lit(5)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("text"))
    fitted = (texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("label", "share", "fold", "text")
              .mapInArrow(_feature_rows, "label int, share double, fold int, columns array<int>")
              .repartition(1).sortWithinPartitions("label", "fold", "columns").mapInArrow(_fit, "model binary"))
    found = fitted.first()
    return bytes(found[0]) if found else pickle.dumps(None)


def score_quality(docs: DataFrame, model: bytes, limit: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` of every row: the probability of label 1, and 1 where it reaches ``limit``.

    A text without features (null, empty) gets the score of the bias alone; without any label
    every score is 0.5.  Repeated rows and null ids are rows like others; an empty table gives
    no rows; other columns are not read.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = pickle.loads(model)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in row_blocks(offsets, BLOCK_BYTES):
                low, n = offsets[first], last - first
                if fitted is None:
                    p = np.full(n, 0.5)
                elif len(fitted) == 4:
                    p = np.full(n, 1.0 if fitted[3] > 0 else 0.0)
                else:
                    weights, ratio, bias, a, b = fitted
                    row, column = features(data[low:offsets[last]], offsets[first:last + 1] - low)
                    scaled = ratio[column]
                    up = np.bincount(row, weights[column] * scaled, minlength=n)
                    norm = np.sqrt(np.maximum(np.bincount(row, scaled * scaled, minlength=n), 1e-12))
                    p = sigmoid(a * (up / norm + bias) + b)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(p), pa.array((p >= limit).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        score, "doc_id long, score double, predicted int")
