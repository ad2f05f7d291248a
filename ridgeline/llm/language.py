"""Language of documents, in two steps: the language family first, then the languages of the family.

Both steps use linear support vector machines, one for each pair of families and one for each
pair of languages of a family, on frequencies of hashed byte n-grams (two to four bytes) of
the normalised text: letters in lower case, everything else one space.  A logistic curve
turns margins into probabilities; the score of a language is the mean of its family's pairwise
probabilities times the mean of its own.

The machines are fitted by one task on at most about ``sample`` documents a language, chosen
by a hash of their id; prediction reads every whole text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.llm.common import BASE, mix, row_blocks, text_bytes
from ridgeline.llm.svm import Rows, hinge_svm, platt, sigmoid

#: Families of common languages.  A language that is not listed is a family of its own.
FAMILIES: dict[str, tuple[str, ...]] = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}
BITS = 16
COLUMNS = 1 << BITS
#: Documents a language that the machines are fitted on, about.
SAMPLE = 800
#: Bytes of text that are worked on at once (a longer text is one block).
BLOCK_BYTES = 1 << 18
#: Scale of the frequencies, so that rows have about unit length.
SCALE = 20.0

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def family(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every n-gram, in row order (not distinct)."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    text = _LETTER[data]
    if len(text) > 1:  # U+00C0 to U+00DE are the upper case of U+00E0 to U+00FE
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        text[1:][upper] += 0x20
    space = text == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    text, row = text[keep], row[keep]
    wide = text.astype(np.uint64)
    rows, columns = [], []
    value = wide + np.uint64(1)
    for n in range(2, 5):
        value = value[:-1] * np.uint64(257) + wide[n - 1:] + np.uint64(1)
        ok = row[n - 1:] == row[:len(row) - n + 1]
        rows.append(row[n - 1:][ok])
        columns.append(((value[ok] * np.uint64(BASE)) >> np.uint64(64 - BITS)).astype(np.int64))
    if len(row) < 4:
        rows, columns = [r for r in rows if len(r)], [c for c in columns if len(c)]
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(columns)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, share, fold, columns, values`` of ``lang, share, fold, text``."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(3))
        for first, last in row_blocks(offsets, BLOCK_BYTES):
            low = offsets[first]
            row, column = grams(data[low:offsets[last]], offsets[first:last + 1] - low)
            key, count = np.unique(row * COLUMNS + column, return_counts=True)
            row, column = key // COLUMNS, key % COLUMNS
            total = np.bincount(row, count, minlength=last - first)
            at = np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(first, last - first) for c in range(3)),
                 pa.ListArray.from_arrays(at, pa.array(column.astype(np.int32))),
                 pa.ListArray.from_arrays(at, pa.array((SCALE * count / total[row]).astype(np.float32)))],
                ["lang", "share", "fold", "columns", "values"])


def _machine(rows: Rows, label: np.ndarray, weight: np.ndarray, fold: np.ndarray) -> tuple:
    learn, held = np.flatnonzero(fold != 0), np.flatnonzero(fold == 0)
    if len(np.unique(label[learn])) < 2 or len(np.unique(label[held])) < 2:
        learn = held = np.arange(len(label))
    y = label[learn]
    cost = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) * 10
    weights = hinge_svm(rows.take(learn), y, COLUMNS, cost)
    a, b = platt(rows.take(held).dot(weights) + weights[-1], label[held], weight[held])
    return weights[:-1].astype(np.float32), float(weights[-1]), a, b


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [b for b in batches if b.num_rows]
    model = None
    if parts:
        table = pa.Table.from_batches(parts).combine_chunks()
        lang = np.array(table.column("lang").to_pylist())
        kin = np.array([family(x) for x in lang])
        weight = 1 / table.column("share").to_numpy()
        fold = table.column("fold").to_numpy()
        lists, values = (table.column(c).combine_chunks() for c in ("columns", "values"))
        rows = Rows(lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(), values.values.to_numpy())
        model = {"families": {k: sorted(set(lang[kin == k])) for k in sorted(set(kin))}, "machines": {}}

        def pairs(names: np.ndarray) -> None:
            for x, y in combinations(sorted(set(names[names != ""])), 2):
                own = np.flatnonzero((names == x) | (names == y))
                model["machines"][x, y] = _machine(rows.take(own), np.where(names[own] == x, 1.0, -1.0), weight[own], fold[own])

        pairs(np.char.add("family ", kin))
        for k in model["families"]:
            pairs(np.where(kin == k, lang, ""))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def fit_language(docs: DataFrame, use: Column | None = None, sample: int = SAMPLE, seed: int = 0) -> bytes:
    """Fit on the documents with a language for which ``use`` holds; returns the model."""
    rows = docs.where(F.col("lang").isNotNull() & (F.lit(True) if use is None else use)).select(
        F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(1 << 30)) / float(1 << 30)
    # one row a language; bounded by sample documents a language, about
    fitted = (rows.join(F.broadcast(counts), "lang").where(draw < F.col("share"))
              .withColumn("fold", F.pmod(F.xxhash64(F.lit(seed + 1), "_id"), F.lit(5)).cast("int"))
              .select("lang", "share", "fold", "text")
              .mapInArrow(_frequencies, "lang string, share double, fold int, columns array<int>, values array<float>")
              .repartition(1).sortWithinPartitions("lang", "fold", "columns", "values").mapInArrow(_fit, "model binary"))
    found = fitted.first()
    return bytes(found[0]) if found else pickle.dumps(None)


def _margin(machine: tuple, row: np.ndarray, column: np.ndarray, total: np.ndarray) -> np.ndarray:
    weights, bias, a, b = machine
    mean = np.bincount(row, weights[column], minlength=len(total)) / np.maximum(total, 1)
    return sigmoid(a * (SCALE * mean + bias) + b)


def _among(names: list[str], machines: dict, prefix: str, *where: np.ndarray) -> np.ndarray:
    """Mean pairwise probability of each name (columns) for each row; one name is certain."""
    out = np.ones((len(where[2]), len(names)))
    if len(names) > 1:
        out[:] = 0
        for x, y in combinations(range(len(names)), 2):
            p = _margin(machines[prefix + names[x], prefix + names[y]], *where)
            out[:, x] += p / (len(names) - 1)
            out[:, y] += (1 - p) / (len(names) - 1)
    return out


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    letter = np.concatenate(([0], np.cumsum((_LETTER[data] != 32) & (data < 128))))
    high = np.concatenate(([0], np.cumsum(data >= 128)))
    has = letter[offsets[1:]] > letter[offsets[:-1]]
    for i in np.flatnonzero(~has & (high[offsets[1:]] > high[offsets[:-1]])):
        has[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return has


def with_language(docs: DataFrame, model: bytes) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``lang_score`` (replaced, if there are such).

    The prediction is the likeliest language of the likeliest family, the score its
    probability.  Null texts and texts without a letter are ``und`` with score 0; so is
    everything if no language was learned.  Ties go to the first name in order.  Repeated rows
    and null ids are rows like others; an empty table gives no rows.
    """
    docs = docs.drop("lang_pred", "lang_score")
    text = docs.columns.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = pickle.loads(model)
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            for first, last in row_blocks(offsets, BLOCK_BYTES):
                low, n = offsets[first], last - first
                block, at = data[low:offsets[last]], offsets[first:last + 1] - low
                known = _has_letter(block, at) if fitted else np.zeros(n, bool)
                names, score = np.full(n, "und", object), np.zeros(n)
                if known.any():
                    row, column = grams(block, at)
                    where = (row, column, np.bincount(row, minlength=n))
                    kin = list(fitted["families"])
                    chance = _among(kin, fitted["machines"], "family ", *where)
                    best = chance.argmax(axis=1)
                    for k, name in enumerate(kin):
                        own = np.flatnonzero(known & (best == k))
                        if len(own):
                            members = fitted["families"][name]
                            inner = _among(members, fitted["machines"], "", *where)[own]
                            pick = inner.argmax(axis=1)
                            names[own] = np.array(members, object)[pick]
                            score[own] = chance[own, k] * inner[np.arange(len(own)), pick]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, n).columns, pa.array(names.tolist(), pa.string()), pa.array(score)],
                    [*batch.schema.names, "lang_pred", "lang_score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]
    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, *added]))


def predict_language(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; see :func:`with_language`.  Other columns are not read."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_language(narrow, model).select("doc_id", "lang_pred", F.col("lang_score").alias("score"))
