"""Periodic runs of words, and texts with the repeats of each run cut out.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``times * q`` words long, that no neighbouring word extends.  Words q apart are then equal over at
least ``(times - 1) * q`` places, so that one of them is a multiple of that number: these places
make up a harmonic grid of n log n candidates over all periods.  Where the two words of a
candidate are equal, longest common extensions to the right and to the left give the exact
stretch; they are answered by the run-length grammar of :mod:`ridgeline.llm.recompression`, built for
a block of texts at a time.  A stretch found under several periods has the smallest one.

A worker holds one block of texts (about ``BLOCK_BYTES``, or one longer text) as word numbers, at
roughly 100 bytes a word; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import row_blocks, text_bytes
from ridgeline.llm.recompression import extensions, recompress

#: Bytes of text in a block, aimed at, and candidates that are looked at together.
BLOCK_BYTES, CANDIDATES = 3 << 20, 1 << 20

RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _grid(sizes: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates (text, place, period) of texts of ``sizes`` words, in bounded portions."""
    periods = np.where(sizes >= least, sizes // times, 0)
    ends = np.cumsum(periods)
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, CANDIDATES // 4):
        flat = np.arange(low, min(low + CANDIDATES // 4, total))
        text = np.searchsorted(ends, flat, "right")
        period = flat - (ends - periods)[text] + 1
        step = np.maximum(least - period, (times - 1) * period)
        number = (sizes[text] - period - 1) // step + 1
        stops = np.cumsum(number)
        first = 0
        while first < len(flat):
            last = max(first + 1, int(np.searchsorted(stops, (stops[first - 1] if first else 0) + CANDIDATES, "right")))
            part = slice(first, last)
            index = np.repeat(np.arange(first, last), number[part])
            place = (np.arange(len(index)) - np.repeat(np.cumsum(number[part]) - number[part], number[part])) * step[index]
            yield text[index], place, period[index]
            first = last


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int, times: int) -> np.ndarray:
    """Runs of texts whose word numbers follow each other in ``words``: rows (text, start, length, period) in order."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    # a separator before every text and after the last one
    at = np.arange(len(sizes)) + 1 + starts
    symbols = np.insert(words, np.append(starts, len(words)), -1 - np.arange(len(sizes) + 1))
    found, grammar = [], None
    for text, place, period in _grid(sizes, least, times):
        i = at[text] + place
        equal = symbols[i] == symbols[i + period]
        if not equal.any():
            continue
        text, i, period = text[equal], i[equal], period[equal]
        if grammar is None:
            grammar = recompress(symbols)
            mirror = grammar.mirrored()
        after = extensions(grammar, i, i + period)
        before = extensions(mirror, len(symbols) - i, len(symbols) - i - period)
        enough = after + before >= np.maximum(least - period, (times - 1) * period)
        found.append(np.stack([text, i - before - at[text], after + before + period, period], axis=1)[enough])
    if not found:
        return np.zeros((0, 4), np.int64)
    rows = np.unique(np.concatenate(found), axis=0)
    keep = np.ones(len(rows), bool)
    keep[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)  # the smallest period of a stretch comes first
    rows = rows[keep]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _block(texts: list[bytes], least: int, times: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Sizes in words, runs, and collapsed texts of a block."""
    split = [t.split() for t in texts]  # at the white space of ASCII: 0x20 and 0x09 to 0x0D
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    number = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
    runs = find_runs(words, sizes, least, times)
    change = np.zeros(len(words) + 1, np.int64)
    begin = (np.cumsum(sizes) - sizes)[runs[:, 0]] + runs[:, 1]
    np.add.at(change, begin + runs[:, 3], 1)
    np.add.at(change, begin + runs[:, 2], -1)
    stays = np.cumsum(change)[:-1] == 0
    low = np.cumsum(sizes) - sizes
    for k in np.unique(runs[:, 0]).tolist():
        split[k] = list(compress(split[k], stays[low[k]:low[k] + sizes[k]].tolist()))
    return sizes, runs, [b" ".join(w) for w in split]


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs``.

    Words are stretches without ASCII white space.  ``runs`` lists all runs of at least ``least`` words and
    ``times`` (2 or more) periods as (start, length, period) in words, ordered by start, then period; ``collapsed`` has the words
    that no run contains after its first period, joined by single spaces.  A null, empty or blank text has no
    words, no runs and an empty ``collapsed``.  Every row gives one row, repeated rows and rows with a null
    ``doc_id`` included; an empty table gives none; other columns are not read.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            raw = data.tobytes()
            for first, last in row_blocks(offsets, BLOCK_BYTES):
                bounds = offsets[first:last + 1].tolist()
                sizes, runs, texts = _block([raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])], least, times)
                structs = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], fields=list(_RUN))
                at = np.searchsorted(runs[:, 0], np.arange(last - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(sizes), pa.ListArray.from_arrays(pa.array(at), structs),
                     pa.array(texts, pa.binary()).view(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        look, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first. Null without runs."""
    return F.reduce(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
                    lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))


def run_lines(runs: Column) -> Column:
    """``start,length,period`` and a line feed of every run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
