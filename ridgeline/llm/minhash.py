"""Near-duplicate documents by MinHash: a multi-index Hamming join over b-bit signatures.

A document's signature is ``SYMBOLS`` MinHash values of its set of word shingles, each cut
to 16 bits; the distance of two signatures is the number of symbols that differ.  The
signature is split into ``CHUNKS`` chunks.  By the pigeonhole principle, of two signatures at
a distance below ``CHUNKS * (ERRORS + 1)`` some chunk pair has at most ``ERRORS`` = 1
differing symbols, so enumerating the one allowed error of each chunk (each symbol left out
in turn) makes the two meet under a key.  Every pair up to distance 31 of 64 meets; at a
similarity of 0.8 the expected distance is 12.8 with a deviation of 3.2, so a link is missed
with a probability of about 1e-7.

Copies are one class from the start.  In every key's bucket all members are first compared
with the smallest one only; their verified links give components.  In buckets that still hold
several components, the pairs across components within the signature distance join documents
to candidate groups (a bucket sends spanning edges, not pairs).  A candidate group is compared
pairwise in blocks of bounded size, again only across components and within the signature
distance, and sends the links that connect its documents.  Links are verified on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import mix, multipliers, row_blocks, text_bytes, written
from ridgeline.llm.graph import components
from ridgeline.llm.shingles import shingle_sets

CHUNKS, CHUNK_SYMBOLS, ERRORS = 16, 4, 1
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
#: Largest distance at which two signatures surely meet.
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Members per block of a bucket, and of a candidate group, that is compared pairwise.
BLOCK, TEXT_BLOCK = 1024, 256


def _signatures(size: int):
    seeds, factors = multipliers(SYMBOLS, 11), multipliers(SYMBOLS, 12)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in row_blocks(offsets):
                low = offsets[first]
                n = last - first
                row, h = shingle_sets(data[low:offsets[last]], offsets[first:last + 1] - low, size)
                count = np.bincount(row, minlength=n)
                some = np.flatnonzero(count)
                at = (np.cumsum(count) - count)[some]
                sets = np.zeros((2, n), np.uint64)
                signature = np.zeros((n, SYMBOLS), np.uint16)
                if len(some):
                    sets[0, some] = np.add.reduceat(mix(h), at)
                    sets[1, some] = np.add.reduceat(mix(h ^ np.uint64(0x5DEECE66D)), at)
                    for j in range(SYMBOLS):
                        least = np.minimum.reduceat((h ^ seeds[j]) * factors[j], at)
                        signature[some, j] = mix(least).astype(np.uint16)
                raw = signature.tobytes()
                width = 2 * SYMBOLS
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(count.astype(np.int64)),
                     pa.array(sets[0].view(np.int64)), pa.array(sets[1].view(np.int64)),
                     pa.array([raw[i:i + width] for i in range(0, len(raw), width)], pa.binary())],
                    ["doc_id", "n_shingles", "set_1", "set_2", "signature"])

    return sign


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, rep``: for every chunk and every symbol left out, the chunk's other symbols with chunk and place."""
    for batch in batches:
        for first in range(0, batch.num_rows, 4096):
            part = batch.slice(first, 4096)
            chunks = _matrix(part.column(1)).astype(np.int64).reshape(-1, CHUNKS, CHUNK_SYMBOLS)
            keys = np.zeros((len(chunks), CHUNKS, CHUNK_SYMBOLS), np.int64)
            for out in range(CHUNK_SYMBOLS):
                key = np.arange(CHUNKS, dtype=np.int64) * CHUNK_SYMBOLS + out
                for j in range(CHUNK_SYMBOLS):
                    if j != out:
                        key = (key << 16) | chunks[:, :, j]
                keys[:, :, out] = key
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1)), pa.array(np.repeat(part.column(0).to_numpy(), SYMBOLS))], ["key", "rep"])


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups; rows are ordered by the first three of ``names``, a group's key."""
    rest: list[pa.Table] = []
    held = 0
    for batch in batches:
        rest.append(pa.Table.from_batches([batch]).select(names))
        held += batch.nbytes
        if held < 4 << 20:
            continue
        table = pa.concat_tables(rest)
        key = [table.column(c).to_numpy() for c in names[:3]]
        other = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = [table.slice(cut)]
        held = rest[0].nbytes
    if rest and (table := pa.concat_tables(rest)).num_rows:
        yield table.combine_chunks()


def _close_pairs(table: pa.Table, keys: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row pairs ``x, y`` of a group, of different blocks or one block's own group, of different
    components, within DISTANCE, and which symbols agree."""
    key = [table.column(c).to_numpy() for c in keys]
    one, two, block, comp = (table.column(c).to_numpy() for c in ("one", "two", "block", "component"))
    signature = _matrix(table.column("signature").combine_chunks())
    n = len(comp)
    new = np.ones(n, bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0)
    start = np.flatnonzero(new)
    end = np.repeat(np.append(start[1:], n), np.diff(np.append(start, n)))
    i, step = np.arange(n), 1
    while len(i := i[i + step < end[i]]):
        for part in np.array_split(i, -(-len(i) // 65_536)):
            j = part + step
            ok = (comp[part] != comp[j]) & ((block[part] != block[j]) | (one[part] == two[part]))
            x, y = part[ok], j[ok]
            same = signature[x] == signature[y]
            close = same.sum(axis=1) >= SYMBOLS - DISTANCE
            if close.any():
                yield x[close], y[close], same[close]
        step += 1


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``a, b``: edges that span what the close pairs of each bucket connect."""
    for table in _groups(batches, ["key", "one", "two", "block", "rep", "component", "signature"]):
        place, rep = table.column("key").to_numpy() >> 48, table.column("rep").to_numpy()
        found = [np.zeros((2, 0), np.int64)]
        for x, y, same in _close_pairs(table, ["key", "one", "two"]):
            chunks = same.reshape(-1, CHUNKS, CHUNK_SYMBOLS)
            chunk = (chunks.sum(axis=2) >= CHUNK_SYMBOLS - ERRORS).argmax(axis=1)
            first = chunk * CHUNK_SYMBOLS + (~chunks[np.arange(len(x)), chunk]).argmax(axis=1)
            own = first == place[x]  # a pair counts under its first common key
            found.append(np.stack((x[own], y[own])))
        x, y = np.concatenate(found, axis=1)
        low = np.arange(len(rep))
        while True:
            before = low.copy()
            np.minimum.at(low, x, low[y])
            np.minimum.at(low, y, low[x])
            low = low[low]
            if (low == before).all():
                break
        more = np.flatnonzero(low != np.arange(len(rep)))
        yield pa.RecordBatch.from_arrays([pa.array(rep[low[more]]), pa.array(rep[more])], ["a", "b"])


def _group_links(size: int, percent: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``a, b``: verified links that span what the links of each block pair connect."""
        for table in _groups(batches, ["candidate", "one", "two", "block", "rep", "component", "signature", "text"]):
            rep, component = table.column("rep").to_numpy(), table.column("component").to_numpy()
            data, offsets = text_bytes(table.column("text"))
            parts = [shingle_sets(data[offsets[f]:offsets[t]], offsets[f:t + 1] - offsets[f], size) for f, t in row_blocks(offsets)]
            h = np.concatenate([p[1] for p in parts])
            count = np.concatenate([np.bincount(p[0], minlength=t - f) for p, (f, t) in zip(parts, row_blocks(offsets))])
            at = np.concatenate(([0], np.cumsum(count))).tolist()
            parent = {c: c for c in component.tolist()}

            def root(c: int) -> int:
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            out = []
            for xs, ys, _ in _close_pairs(table, ["candidate", "one", "two"]):
                fits = 100 * np.minimum(count[xs], count[ys]) >= percent * np.maximum(count[xs], count[ys])
                for x, y in zip(xs[fits].tolist(), ys[fits].tolist()):
                    a, b = root(int(component[x])), root(int(component[y]))
                    if a == b:
                        continue
                    p, q = h[at[x]:at[x + 1]], h[at[y]:at[y + 1]]
                    spot = np.searchsorted(p, q)
                    spot[spot == len(p)] = 0
                    both = int((p[spot] == q).sum())
                    if 100 * both >= percent * (len(p) + len(q) - both):
                        parent[max(a, b)] = min(a, b)
                        out.append((int(rep[x]), int(rep[y])))
            columns = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return links


def _block_pairs(rows: DataFrame, key: str, sizes: DataFrame, block: int) -> DataFrame:
    """``rows`` dealt into blocks of each ``key`` (``sizes``: key, n) and copied to each pair of blocks they are in."""
    blocks = sizes.select(key, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    return (rows.join(blocks, key)
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("blocks", "other")
            .repartition(key, "one", "two").sortWithinPartitions(key, "one", "two"))


def _linked(size: int, percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 128):
                part = batch.slice(first, 128)
                sides = [shingle_sets(*text_bytes(part.column(c)), size) for c in (2, 3)]
                n = [np.bincount(r, minlength=part.num_rows) for r, _ in sides]
                row, h = (np.concatenate([s[k] for s in sides]) for k in (0, 1))
                order = np.lexsort((h, row))
                row, h = row[order], h[order]
                both = np.bincount(row[1:][(row[1:] == row[:-1]) & (h[1:] == h[:-1])], minlength=part.num_rows)
                linked = 100 * both >= percent * (n[0] + n[1] - both)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(linked))

    return check


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose full shingle sets have ``100 * intersection >= percent * union``."""
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(_linked(size, percent), "a long, b long"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Documents link whose sets of ``size``-word shingles have a similarity of ``percent`` / 100
    or more; a component is what links reach, named by its smallest ``doc_id``, which is kept.
    Null, empty and word-less texts have an empty set and link with nothing; so do rows with a
    null ``doc_id`` (component null, kept).  Rows that repeat a document get the same result.
    An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = written(rows.mapInArrow(
        _signatures(size), "doc_id long, n_shingles long, set_1 long, set_2 long, signature binary"), "signatures")
    same_set = ["n_shingles", "set_1", "set_2"]
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy(*same_set).agg(F.min("doc_id").alias("rep"))
    reps = some.groupBy(*same_set, "signature").agg(F.min("doc_id").alias("rep")).select("rep", "signature")
    members = reps.mapInArrow(_keys, "key long, rep long")
    buckets = members.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    shared = written(members.join(buckets, "key").select("key", "rep", "low"), "buckets")
    candidates = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = written(rows.join(candidates, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "candidate-texts")
    stars = shared.where("rep != low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    links = written(verified(stars, texts, size, percent), "links")
    found = components(links)
    mixed = (shared.join(found.withColumnRenamed("node", "rep"), "rep", "left")
             .select("key", "rep", F.coalesce("component", "rep").alias("component")))
    open_keys = (mixed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
                 .where("x < y").select("key", "n"))
    close = _block_pairs(mixed.join(reps, "rep"), "key", open_keys, BLOCK).mapInArrow(_candidates, "a long, b long")
    groups = components(close).select(F.col("node").alias("rep"), F.col("component").alias("candidate"))
    in_groups = (groups.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
                 .join(reps, "rep").join(texts.withColumnRenamed("doc_id", "rep"), "rep"))
    more = written(_block_pairs(in_groups, "candidate", groups.groupBy("candidate").agg(F.count("*").alias("n")), TEXT_BLOCK)
                   .mapInArrow(_group_links(size, percent), "a long, b long"), "more-links")
    found = components(links.union(more)).select(F.col("node").alias("rep"), "component")
    named = classes.join(found, "rep", "left").select(*same_set, F.coalesce("component", "rep").alias("component"))
    in_class = F.when(F.col("doc_id").isNotNull(), F.col("n_shingles"))
    out = signed.withColumn("_n", in_class).join(named.withColumnRenamed("n_shingles", "_n"), ["_n", "set_1", "set_2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (out.withColumn("component_id", component)
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))
