"""Removal of repeated byte strings of a corpus, by suffix arrays.

A byte goes if a ``LENGTH``-byte string that covers it also starts earlier (smaller
``doc_id``, or the same document at a smaller offset).  Every ``LENGTH``-byte window of a
document is dealt to the smallest hash among its ``GRAM``-byte grams, so equal windows meet
under one hash; consecutive windows of one hash are one row (a stretch), not one row each.

1. Count the stretches of every hash; one of a hash that occurs once repeats nothing unless its
   windows repeat each other (a periodic text).
2. Of equal stretches under one hash the earliest stays, the others repeat it.
3. Different stretches of one hash, or one that may repeat itself, are put together in strings of a few and suffix-sorted:
   equal windows are then neighbours.  A hash with more stretches is dealt into several
   strings; the earliest window of each class leaves its string and the
   earliest of all is found by aggregation, so no hash is too frequent.  Those windows leave
   in rows of up to ``CORE_WINDOWS`` at fixed distances from their smallest gram; what the
   windows of a row have in common, its core, must occur in two rows for them to be compared.
   A row holds the hash of its core and the few bytes on either side, which with it tell its windows apart.
4. Windows that repeat an earlier one give the spans to remove.

Step 3 takes the hashes in rounds, as many as keep the bytes cut in one below a half of the texts;
what a step has written is removed once the next no longer reads it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.llm.common import mix, prefix_hash, row_blocks, segment_hash, stored, text_bytes
from ridgeline.llm.suffix_order import suffix_arrays
from ridgeline.session import drop_path

LENGTH, GRAM = 100, 24
#: Grams per window; also the most windows of a stretch.
GRAMS = LENGTH - GRAM + 1
#: Different stretches that are suffix-sorted as one string; a hash with more has several strings.
STRING_STRETCHES = 16
#: Symbols of a matrix of strings that is sorted at once.
MATRIX = 1 << 20
#: Neighbouring windows that are looked up by their common core first; the bytes beside it fit in a long.
CORE_WINDOWS = 8
#: Bytes that a round may cut out of any corpus; of a large one, half its bytes.
ROUND_BYTES = 1 << 28


def stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, offset in the row, number of windows, hash, content digest and inner repeats of every stretch of a block of rows.

    Equal windows of a stretch make it periodic there, and one of its windows before the last
    starts with the smallest gram, which then occurs again; stretches without such a window
    have no inner repeats.
    """
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    prefix = prefix_hash(data)
    at = np.arange(n - GRAM + 1)
    gram, span = segment_hash(prefix, at, at + GRAM), 1
    least = gram
    while 2 * span <= GRAMS:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if GRAMS > span:
        least = np.minimum(least[:span - GRAMS], least[GRAMS - span:])
    size = np.diff(offsets)
    row_of = np.repeat(np.arange(len(size)), np.maximum(size - LENGTH + 1, 0))
    window = np.arange(len(row_of)) - np.repeat(np.cumsum(np.maximum(size - LENGTH + 1, 0)) - np.maximum(size - LENGTH + 1, 0),
                                                np.maximum(size - LENGTH + 1, 0)) + offsets[row_of]
    value = least[window]
    new = np.ones(len(window), bool)
    new[1:] = (row_of[1:] != row_of[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    run = np.diff(np.append(first, len(window)))
    pieces = -(-run // GRAMS)  # a run of a periodic text may be long
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first, run = np.repeat(first, pieces) + piece * GRAMS, np.minimum(np.repeat(run, pieces) - piece * GRAMS, GRAMS)
    low, row = window[first], row_of[first]
    digest = mix(segment_hash(prefix, low, low + run + LENGTH - 1) + run.astype(np.uint64))
    starts = gram[window] == value
    starts[first + run - 1] = False
    inner = np.zeros(len(first), bool)
    inner[np.searchsorted(first, np.flatnonzero(starts), "right") - 1] = True
    return row, low - offsets[row], run, value[first], digest, inner


def _stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch.column(0).to_numpy()
        data, offsets = text_bytes(batch.column(1))
        for first, last in row_blocks(offsets):
            low = offsets[first]
            row, at, run, value, digest, inner = stretches(data[low:offsets[last]], offsets[first:last + 1] - low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(doc[first + row]),
                 pa.array(at << 8 | inner << 7 | run), pa.array(inner)], ["h", "digest", "doc_id", "place", "inner"])


def _stretch_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _stretch_rows(batches):
        yield batch.select(["h", "inner"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of each wanted stretch: ``h, part, parts, doc_id, low, bytes`` from ``doc_id, text, wanted``."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        wanted = batch.column("wanted")
        each = wanted.values.flatten()
        names = [f.name for f in wanted.type.value_type]
        h, part, parts, place = (each[names.index(c)].to_numpy(zero_copy_only=False) for c in ("h", "part", "parts", "place"))
        row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
        low, run = place >> 8, place & 127
        start = offsets[row] + low
        raw = memoryview(data)
        cut = [bytes(raw[a:b]) for a, b in zip(start.tolist(), (start + run + LENGTH - 1).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(part), pa.array(parts), pa.array(batch.column("doc_id").to_numpy()[row]),
             pa.array(low), pa.array(cut, pa.binary())], ["h", "part", "parts", "doc_id", "low", "bytes"])


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix-sort strings of stretches (rows ordered by ``h, part, doc_id, low``) and report repeats.

    ``core`` null: ``n`` windows from ``low`` repeat earlier ones of their string.  Else (a hash
    with several strings): the windows that begin d bytes before ``low``, for every bit d of ``n``,
    share ``core`` and are each the earliest of its class in its string; ``left`` and ``right``
    are the bytes beside the core.
    """
    names = ["h", "part", "parts", "doc_id", "low", "bytes"]
    out = ["core", "doc_id", "low", "n", "left", "right"]

    def matrices(table: pa.Table) -> Iterator[pa.RecordBatch]:
        h, part, doc, low = (table.column(c).to_numpy() for c in ("h", "part", "doc_id", "low"))
        once = np.ones(len(h), bool)  # rows that repeat a document repeat its stretches
        once[1:] = (h[1:] != h[:-1]) | (part[1:] != part[:-1]) | (doc[1:] != doc[:-1]) | (low[1:] != low[:-1])
        if not once.all():
            table = table.filter(pa.array(once)).combine_chunks()
        h, part, parts, doc, low = (table.column(c).to_numpy() for c in names[:5])
        raw, at = text_bytes(table.column("bytes"))
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (part[1:] != part[:-1])
        string = np.cumsum(new) - 1
        size = np.diff(at)
        begin = np.flatnonzero(new)
        space = np.cumsum(size + 1) - (size + 1)
        inner = space - space[begin][string]  # a separator follows each stretch
        length = np.add.reduceat(size + 1, begin) if len(begin) else np.zeros(0, np.int64)
        order = np.argsort(length, kind="stable")
        stretches_of = np.append(begin, len(h))
        first = 0
        while first < len(order):
            wide = length[order[first:]]
            fits = (np.arange(len(wide)) + 1) * wide <= MATRIX
            last = first + max(1, int(np.searchsorted(~fits, True)))
            chosen = order[first:last]
            member = np.concatenate([np.arange(stretches_of[s], stretches_of[s + 1]) for s in chosen])
            row = np.repeat(np.arange(len(chosen)), stretches_of[chosen + 1] - stretches_of[chosen])
            yield from repeats(raw, at, size, member, row, inner[member], length[chosen], h, parts, doc, low)
            first = last

    def repeats(raw, at, size, member, row, inner, length, h, parts, doc, low) -> Iterator[pa.RecordBatch]:
        width = int(length.max())
        text = np.zeros((len(length), width), np.int16)
        n = size[member]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        to = np.repeat(row * width + inner, n) + within
        text.reshape(-1)[to] = raw[np.repeat(at[member], n) + within].astype(np.int16) + 1
        # windows: their string, their place in it and their stretch
        windows = n - LENGTH + 1
        of = np.repeat(np.arange(len(member)), windows)
        step = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        stretch_at = np.full(len(length) * width, -1, np.int32)
        stretch_at[(row * width + inner)[of] + step] = of
        order = suffix_arrays(text, length).astype(np.int64)
        spot = (order + np.arange(len(length))[:, None] * width)[order >= 0]
        spot = spot[stretch_at[spot] >= 0]
        same = np.zeros(len(spot), bool)
        same[1:] = spot[1:] // width == spot[:-1] // width
        whole = prefix_hash(text.reshape(-1))
        digest = segment_hash(whole, spot, spot + LENGTH)
        same[1:] &= digest[1:] == digest[:-1]
        views = np.lib.stride_tricks.sliding_window_view(text.reshape(-1), LENGTH)
        check = np.flatnonzero(same)
        for some in np.array_split(check, -(-len(check) // 65_536) or 1):
            same[some] = (views[spot[some]] == views[spot[some - 1]]).all(axis=1)
        heads = np.flatnonzero(~same)
        # stretches of a string ascend by document and offset, so the smallest place is the earliest window
        earliest = np.minimum.reduceat(spot, heads) if len(heads) else spot
        counts = np.diff(np.append(heads, len(spot)))
        again = np.sort(spot[spot != np.repeat(earliest, counts)])
        if len(again):
            s = stretch_at[again]
            new = np.ones(len(again), bool)
            new[1:] = (again[1:] != again[:-1] + 1) | (s[1:] != s[:-1])
            first = np.flatnonzero(new)
            run = np.diff(np.append(first, len(again)))
            m = member[s[first]]
            start = low[m] + again[first] - (row * width + inner)[s[first]]
            none = pa.nulls(len(m), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(doc[m]), pa.array(start), pa.array(run), none, none], out)
        if len(heads) and (parts[member] > 1).any():
            earliest = np.sort(earliest)
            s = stretch_at[earliest]
            spread = parts[member[s]] > 1
            yield from cores(text, earliest[spread], s[spread], row * width + inner, member, n, h, doc, low)

    def cores(text, spots, s, begin, member, n, h, doc, low) -> Iterator[pa.RecordBatch]:
        if not len(spots):
            return
        flat = (text.reshape(-1) - 1).astype(np.uint8)
        prefix = prefix_hash(flat)
        places = np.arange(len(flat) - GRAM + 1)
        own = np.zeros(len(flat), np.int64)
        own[np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = np.repeat(h[member], n)
        hit = segment_hash(prefix, places, places + GRAM).view(np.int64) == own[:len(places)]
        gram = np.minimum.accumulate(np.where(hit, places, len(flat))[::-1])[::-1][spots]  # leftmost in the window
        far = (gram - spots) // CORE_WINDOWS * CORE_WINDOWS
        new = np.ones(len(spots), bool)
        new[1:] = (s[1:] != s[:-1]) | (gram[1:] != gram[:-1]) | (far[1:] != far[:-1])
        first = np.flatnonzero(new)
        at, m = (gram - far)[first], member[s[first]]
        size = LENGTH - CORE_WINDOWS + 1
        core = mix((segment_hash(prefix, at, at + size) + far[first].astype(np.uint64)) ^ mix(h[m].view(np.uint64)))
        back = (gram - far) - spots  # bytes of a window before its core; it has CORE_WINDOWS - 1 on both sides
        bits = np.bitwise_or.reduceat(np.int64(1) << back, first)
        most, least = np.maximum.reduceat(back, first), np.minimum.reduceat(back, first)
        side = CORE_WINDOWS - 1
        digits = 256 ** np.arange(side - 1, -1, -1)
        left, right = (flat[np.clip(a[:, None] + np.arange(side), 0, len(flat) - 1)].astype(np.int64) @ digits for a in (at - side, at + size))
        left, right = left % (np.int64(1) << 8 * most), right >> 8 * least << 8 * least  # what its windows hold
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (core.view(np.int64), doc[m], low[m] + at - begin[s[first]], bits, left, right)], out)

    rest, held = [], 0
    for batch in batches:
        rest.append(pa.Table.from_batches([batch]).select(names))
        held += batch.nbytes
        if held < 2 * MATRIX:
            continue
        table = pa.concat_tables(rest)
        h, part = table.column("h").to_numpy(), table.column("part").to_numpy()
        other = np.flatnonzero((h != h[-1]) | (part != part[-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield from matrices(table.slice(0, cut).combine_chunks())
        rest = [table.slice(cut)]
        held = rest[0].nbytes
    if rest:
        table = pa.concat_tables(rest).combine_chunks()
        if table.num_rows:
            yield from matrices(table)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns but ``text`` and ``spans``, then ``n_bytes, n_removed, n_spans, kept``."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        others = [c for c in batch.schema.names if c not in ("text", "spans")]
        for first, last in row_blocks(offsets):
            part = batch.slice(first, last - first)
            out: list[tuple] = []
            for k, spans in enumerate(part.column("spans").to_pylist(), first):
                raw = data[offsets[k]:offsets[k + 1]]
                if not spans:
                    out.append((len(raw), 0, 0, raw.tobytes()))
                    continue
                low = np.minimum(np.array([s["low"] for s in spans]), len(raw))
                high = np.minimum(low + np.array([s["n"] for s in spans]) + LENGTH - 1, len(raw))
                depth = np.zeros(len(raw) + 1, np.int32)
                np.add.at(depth, low, 1)
                np.add.at(depth, high, -1)
                gone = np.cumsum(depth[:-1]) > 0
                begins = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(gone.sum()), begins, raw[~gone].tobytes()))
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in others), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                [*others, "n_bytes", "n_removed", "n_spans", "kept"])


def _round_spans(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, str]:
    """``doc_id, low, n`` of windows of the ``wanted`` stretches that repeat another stretch's; the path is for ``drop_path``."""
    listed = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("h", "part", "parts", "place")).alias("wanted"))
    cut = (rows.join(listed, "doc_id").select("doc_id", "text", "wanted")
           .mapInArrow(_cut, "h long, part int, parts int, doc_id long, low long, bytes binary"))
    windows, windows_path = stored(cut.repartition("h", "part").sortWithinPartitions("h", "part", "doc_id", "low")
                                   .mapInArrow(_sorted_windows, "core long, doc_id long, low long, n long, left long, right long"),
                                   "repeats")
    cores = windows.where("core IS NOT NULL")
    common = cores.groupBy("core").count().where("count > 1").select("core")
    shared, shared_path = stored(cores.join(common, "core"), "cores")
    side = 8 * (CORE_WINDOWS - 1)
    spread = (shared.withColumn("d", F.expr(f"explode(filter(sequence(0, {CORE_WINDOWS - 1}), d -> shiftright(n, d) % 2 = 1))"))
              .select("core", "doc_id", (F.col("low") - F.col("d")).alias("low"),
                      F.expr(f"shiftleft(CAST(d AS BIGINT), {side})"
                             f" | shiftleft(left & (shiftleft(1L, 8 * d) - 1), {side} - 8 * d) | shiftright(right, 8 * d)").alias("window")))
    across = (spread.join(spread.groupBy("core", "window").agg(F.min(F.struct("doc_id", "low")).alias("first")), ["core", "window"])
              .where("doc_id != first.doc_id OR low != first.low").select("doc_id", "low", F.lit(1).cast("long").alias("n")))
    spans = stored(windows.where("core IS NULL").select("doc_id", "low", "n").union(across), "round-spans")
    for path in (windows_path, shared_path):
        drop_path(rows.sparkSession, path)
    return spans


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``doc_id, spans`` (array of ``low, n``: n windows from byte ``low``) of the documents that repeat something.

    ``rows`` has ``doc_id`` (not null) and ``text``.
    """
    frequent, frequent_path = stored(rows.mapInArrow(_stretch_hashes, "h long, inner boolean").groupBy("h")
                                     .agg(F.count("*").alias("count"), F.max("inner").alias("inner"))
                                     .where("count > 1 OR inner").select("h"), "frequent")
    found = rows.mapInArrow(_stretch_rows, "h long, digest long, doc_id long, place long, inner boolean").drop("inner")
    repeated, repeated_path = stored(found.join(frequent, "h"), "stretches")
    drop_path(rows.sparkSession, frequent_path)
    earliest = repeated.groupBy("h", "digest").agg(F.min(F.struct("doc_id", "place")).alias("first"))
    run = F.col("place").bitwiseAND(F.lit(127))
    copies = (repeated.join(earliest, ["h", "digest"])
              .where("doc_id != first.doc_id OR place != first.place")
              .select("doc_id", F.shiftright("place", 8).alias("low"), run.alias("n")))
    different = earliest.select("h", "digest", "first.doc_id", "first.place")
    several = (different.groupBy("h").agg(F.count("*").alias("count"), F.max(F.col("place").bitwiseAND(F.lit(128))).alias("inner"))
               .where("count > 1 OR inner > 0")
               .select("h", F.ceil(F.col("count") / STRING_STRETCHES).cast("int").alias("parts")))
    wanted, wanted_path = stored(different.join(several, "h")
                                 .select("h", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int").alias("part"), "parts", "doc_id", "place"),
                                 "wanted")
    size = wanted.agg(F.sum(run + LENGTH - 1)).first()[0] or 0
    half = rows.agg(F.sum(F.octet_length("text"))).first()[0] // 2 if size > ROUND_BYTES else 0
    rounds = -(-size // max(half, ROUND_BYTES))
    several_spans = [_round_spans(rows, wanted.where(F.pmod(F.xxhash64("h"), F.lit(rounds)) == k)) for k in range(rounds)]
    spans = copies
    for some, _ in several_spans:
        spans = spans.union(some)
    out = stored(spans.groupBy("doc_id").agg(F.collect_list(F.struct("low", "n")).alias("spans")), "spans")[0]
    for path in (repeated_path, wanted_path, *(path for _, path in several_spans)):
        drop_path(rows.sparkSession, path)
    return out


def remove_repeats(docs: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row: ``kept`` holds the remaining bytes.

    Null text is empty.  Rows with a null ``doc_id`` have no place in the order: they are not
    compared and keep all bytes.  Rows that repeat a document (id and text) are one document
    and get the same result.  An empty table gives no rows; of other columns only ``others``
    are read, and carried along as ``other_<name>``.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *(F.col(c).alias(f"other_{c}") for c in others))
    placed = rows.where("doc_id IS NOT NULL")
    spans = repeated_spans(placed.select("doc_id", "text"))
    nothing = rows.where("doc_id IS NULL").withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
    joined = placed.join(spans, "doc_id", "left").select(*rows.columns, "spans").union(nothing)
    added = [*(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())]
    return joined.mapInArrow(_removed, T.StructType([*rows.drop("text").schema.fields, *added]))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with the repeated strings cut out of ``text`` and ``n_chars`` to match.

    A character of which a cut took some bytes goes as a whole.  Null text becomes empty text.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = remove_repeats(docs, others).withColumn("text", F.try_validate_utf8(F.col("kept").cast("string")))
    text = F.coalesce(F.col("text"), F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\uFFFD", ""))
    restored = cut.select("doc_id", text.alias("text"), *(F.col(f"other_{c}").alias(c) for c in others))
    if "n_chars" in docs.columns:
        restored = restored.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return restored.select(*docs.columns)


def sha256(kept: DataFrame) -> DataFrame:
    """Replace ``kept`` by ``kept_sha256`` (lowercase hex)."""
    return kept.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
