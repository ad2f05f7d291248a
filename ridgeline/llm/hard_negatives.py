"""Hard negatives of anchors by a multiway hyperplane tree (see :mod:`ridgeline.llm.hyperplane_tree`).

The root of the tree lies across the cluster: its split points are chosen farthest first from a
bounded sample, every vector goes to the shard of its nearest one, and the ranges of distances from
every split point to every shard are one aggregate.  A shard is dealt by a hash into parts of bounded
bytes; a task holds one part, grows the rest of the tree over it, and answers one block of queries.

1. Of vectors that are equal in one label only the first few ids can ever be answers, so the others
   are left out of the tree (not of the anchors) before anything is dealt.
2. Every anchor asks its nearest shard for its best vectors of its own label.  What it found there is
   the floor with which it asks the other shards that hold its label and that the ranges leave.
3. Each of its positives gives a window of scores.  Again the nearest shard comes first and its answers
   raise the windows' floors; then the other shards that the ranges leave are asked.

Anchors are a stated share of all rows; they meet the parts in blocks.  Vectors of different length
never meet; those of lengths other than the most frequent one, or too long for exact sums of floats, have a
shard of their own, which every query of their length asks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import written
from ridgeline.llm.hyperplane_tree import (
    TAME, Search, Tree, annulus, between, farthest_first, raised, reachable, scan, to_splits)

#: Most split points of the root, sampled vectors that they are chosen from, and most bytes of that sample.
ROUTES, SAMPLE, SAMPLE_BYTES = 256, 2_048, 16 << 20
#: Vectors of a part and its bytes, and queries of a block: at most, but for the scatter of the hash.
PART, PART_BYTES, BLOCK = 8_192, 32 << 20, 2_048
#: The shard of vectors whose norm is beyond ``TAME``.
WILD = -1

_NONE, _ALL = -(1 << 63), (1 << 63) - 1


class Root(NamedTuple):
    """Split points of the root for vectors of ``width`` components, and ranges of distances to the shards."""

    width: int
    m2: float
    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64).reshape(len(column), width)


def participants(rows: DataFrame, scale: float) -> DataFrame:
    """``vec_id, label, vector, norm, width`` of the rows that take part: distinct, components scaled and floored."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # beyond 2**52 a double has no fraction; a bigint would overflow later on
    whole = F.transform("vector", lambda x: F.when(F.abs(x) < TAME, F.floor(x).cast("double")).otherwise(x))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                        F.transform(F.col("embedding").cast("array<double>"), lambda x: x * F.lit(scale)).alias("vector"))
            .where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(finite)
            .withColumn("vector", whole).withColumn("norm", norm).where(F.col("norm") < float(1 << 62))
            .withColumn("width", F.size("vector")).distinct())


def _split_points(targets: DataFrame, part: int, routes: int) -> Root | None:
    """Split points for the most frequent length of vectors; none where one part holds them all."""
    tame = targets.where(F.col("norm") <= TAME)
    top = tame.groupBy("width").agg(F.count("*").alias("n"), F.max("norm").alias("m2")).orderBy(F.desc("n"), "width").first()
    if top is None or top.n <= part or not top.width:
        return None
    most = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * top.width)))
    draw = F.pmod(F.xxhash64(F.lit(3), "vec_id", "label", "vector"), F.lit(1 << 30))
    sample = (tame.where((F.col("width") == top.width) & (draw < F.lit(int(min(1.0, 2 * most / top.n) * (1 << 30)))))
              .select("vector").orderBy(draw, "vec_id", "label").limit(most).toPandas())
    x = _matrix(sample["vector"], top.width)
    m2 = max(top.m2, 1.0)
    extra = raised(x, m2)
    k = min(routes, max(2, -(-2 * top.n // part)))
    some = slice(0, 3 * k)
    splits = x[some][farthest_first(x[some], extra[some], k, m2)]
    return Root(top.width, m2, splits, np.zeros((0, 0)), np.zeros((0, 0))) if len(splits) > 1 else None


def _placed(targets: DataFrame, root: Root | None) -> DataFrame:
    """``targets`` with ``shard``."""
    wild = F.when(F.col("norm") > TAME, F.lit(WILD)).otherwise(F.lit(0))
    if root is None:
        return targets.withColumn("shard", wild)

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extra = raised(root.splits, root.m2)
        for part in parts:
            mine = (part["shard"] != WILD).to_numpy() & (part["width"] == root.width).to_numpy()
            shard = part["shard"].to_numpy().copy()
            if mine.any():
                x = _matrix(part["vector"][mine], root.width)
                shard[mine] = between(x, raised(x, root.m2), root.splits, extra, root.m2).argmin(axis=1)
            yield part.assign(shard=shard)

    marked = targets.withColumn("shard", wild)
    return marked.mapInPandas(place, marked.schema)


def _with_ranges(root: Root, placed: DataFrame) -> Root:
    """The root with the smallest and largest distance from every split point to every shard's vectors."""
    k = len(root.splits)

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extra = raised(root.splits, root.m2)
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for part in parts:
            x, shard = _matrix(part["vector"], root.width), part["shard"].to_numpy()
            gap = between(x, raised(x, root.m2), root.splits, extra, root.m2)
            for j in np.unique(shard):
                low[:, j] = np.minimum(low[:, j], gap[shard == j].min(axis=0))
                high[:, j] = np.maximum(high[:, j], gap[shard == j].max(axis=0))
        at = np.flatnonzero(np.isfinite(low))
        yield pd.DataFrame({"cell": at, "low": low.ravel()[at], "high": high.ravel()[at]})

    cells = (placed.where((F.col("width") == root.width) & (F.col("shard") != WILD)).select("vector", "shard")
             .mapInPandas(measure, "cell int, low double, high double")
             .groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas())
    low, high = np.full(k * k, np.inf), np.full(k * k, -np.inf)
    low[cells["cell"]], high[cells["cell"]] = cells["low"], cells["high"]
    return root._replace(low=low.reshape(k, k), high=high.reshape(k, k))


def _windows(column: pd.Series) -> np.ndarray:
    return np.array(column.to_list(), np.int64)


def _routed(queries: DataFrame, root: Root | None, nearest: bool) -> DataFrame:
    """``queries`` with ``shard``: the nearest of the shards in ``present``, or the others that the ranges leave."""

    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            goes = [list(p) for p in part["present"]]
            first = [p[:1] for p in goes]
            tame = (part["norm"] <= TAME).to_numpy()
            at = np.flatnonzero(tame & (part["width"] == root.width).to_numpy()) if root is not None else []
            if len(at):
                q = _matrix(part["vector"].iloc[at], root.width)
                low = _windows(part["low"].iloc[at]).min(axis=1).astype(np.float64)
                high = _windows(part["high"].iloc[at]).max(axis=1).astype(np.float64)
                gap = to_splits(q, root.splits, root.m2)
                inner, outer = annulus(q, np.where(low == _NONE, -np.inf, low), np.where(high == float(_ALL), np.inf, high), root.m2)
                see = reachable(gap, root.low, root.high, inner, outer, root.m2)
                for row, i in enumerate(at):
                    shards = np.array([s for s in goes[i] if s != WILD], np.int64)
                    wild = [s for s in goes[i] if s == WILD]
                    first[i] = [int(shards[gap[row, shards].argmin()])] if len(shards) else wild
                    goes[i] = shards[see[row, shards]].tolist() + wild
            shard = first if nearest else [[s for s in g if s not in f] for g, f in zip(goes, first)]
            yield part.assign(shard=shard)

    schema = ", ".join(f"{n} {t}" for n, t in queries.dtypes) + ", shard array<int>"
    return queries.mapInPandas(route, schema).withColumn("shard", F.explode("shard"))


def _answers(same: bool, k: int):
    def answer(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """Answers of one part to one block of queries."""
        if not len(rows) or not len(queries):
            return pd.DataFrame({"anchor": [], "window": [], "score": [], "other": []})
        rows = rows.sort_values(["vec_id", "label"], ignore_index=True)
        width = int(rows["width"].iloc[0])
        x, ids, labels = _matrix(rows["vector"], width), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        out = []
        wild_rows = rows["norm"].iloc[0] > TAME
        wild = np.full(len(queries), True) if wild_rows else (queries["norm"] > TAME).to_numpy()
        for group, by_tree in ((queries[~wild], True), (queries[wild], False)):
            if not len(group):
                continue
            own, label = group["vec_id"].to_numpy(), group["label"].to_numpy()

            def allowed(asks: np.ndarray, at: np.ndarray, own=own, label=label) -> np.ndarray:
                alike = label[asks][:, None] == labels[at][None, :]
                return (alike == same) & (own[asks][:, None] != ids[at][None, :])

            low, high, q = _windows(group["low"]), _windows(group["high"]), _matrix(group["vector"], width)
            if by_tree:
                low, high = np.where(low == _NONE, -np.inf, low), np.where(high == _ALL, np.inf, high)
                found = Search(Tree(x, float(rows["norm"].max())), q, low, high, k, allowed).run()
            else:
                found = scan(x, q, low, high, k, allowed)
            out.append(pd.DataFrame({"anchor": group["anchor"].to_numpy()[found[0]], "window": found[1], "score": found[2], "other": ids[found[3]]}))
        return pd.concat(out)

    return answer


class _Index(NamedTuple):
    placed: DataFrame
    parts: DataFrame
    root: Root | None


def _ask(index: _Index, routed: DataFrame, same: bool, k: int, block: int) -> DataFrame:
    """``anchor, window, score, other``: answers of every part of the shards that each query goes to."""
    key = ["width", "shard"]
    blocks = routed.groupBy(*key).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    tasks = index.parts.join(blocks, key)
    rows = (index.placed.join(tasks, key).withColumn("part", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.col("parts")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    asks = (routed.join(tasks, key).withColumn("block", F.pmod(F.xxhash64("anchor"), F.col("blocks")).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    key = [*key, "part", "block"]
    return (rows.select(*key, "vec_id", "label", "vector", "norm").groupBy(*key)
            .cogroup(asks.select(*key, "anchor", "vec_id", "label", "vector", "norm", "low", "high").groupBy(*key))
            .applyInPandas(_answers(same, k), "anchor long, window int, score long, other long"))


def _first(answers: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "other")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _best(index: _Index, queries: DataFrame, same: bool, k: int, block: int, name: str) -> DataFrame:
    """``anchor, window, score, other, rank``: the ``k`` first answers of all rows to every window."""
    near = written(_first(_ask(index, _routed(queries, index.root, True), same, k, block), k), f"{name}-near")
    # the k-th answer, where there is one, is the floor of its window
    floors = (near.where(F.col("rank") == k).groupBy("anchor")
              .agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floors")))
    raised_low = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("floors", w), x)))
    asking = queries.join(floors, "anchor", "left").withColumn("low", raised_low).drop("floors")
    rest = _ask(index, _routed(asking, index.root, False), same, k, block)
    return written(_first(near.drop("rank").unionByName(rest), k), name)


def mine_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   scale: float = 256.0, part: int = PART, block: int = BLOCK, routes: int = ROUTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of the anchors of ``rows``.

    ``rows`` has ``vec_id``, ``embedding`` and ``label``; ``anchors`` is a condition on ``vec_id`` and ``label`` that picks the anchors.  A
    component x counts as ``floor(scale * x)``; a score is the integer inner product with the anchor; higher scores come first, ties
    by smaller ``vec_id``.  An anchor's positives are its first ``positives`` other rows of its label (all, if fewer); its negatives
    for a positive are the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.  A positive without any gives no row.

    Rows whose id, label or vector is null, or that hold a null or non-finite component, take no part; nor do vectors whose
    scaled squared norm is 2**62 or more, whose scores a long could not hold.  Repeated rows count once; rows that share an id but
    not a label or vector are rows of their own, except that no row under the anchor's id is among its positives or
    negatives.  Vectors of different length never meet; empty vectors have score 0 with each other.  An empty table gives no rows;
    other columns are not read.
    """
    found = participants(rows, scale)
    asked = written(found.where(anchors).withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    # an anchor itself and as many others as can be answers: the first ids of equal vectors in a label
    few = F.row_number().over(Window.partitionBy("label", "vector").orderBy("vec_id"))
    targets = written(found.withColumn("_few", few).where(F.col("_few") <= max(positives, negatives) + 1).drop("_few"), "targets")
    root = _split_points(targets, part, routes)
    placed = written(_placed(targets, root), "placed")
    if root is not None:
        root = _with_ranges(root, placed)
    size = F.least(F.lit(part), F.greatest(F.lit(1), F.floor(F.lit(PART_BYTES) / (8 * F.greatest("width", F.lit(1))))))
    parts = placed.groupBy("width", "shard").count().select("width", "shard", F.ceil(F.col("count") / size).cast("int").alias("parts"))
    index = _Index(placed, parts, root)

    by_label = placed.groupBy("width", "label").agg(F.array_sort(F.collect_set("shard")).alias("present"))
    queries = (asked.join(by_label, ["width", "label"]).withColumn("low", F.array(F.lit(_NONE))).withColumn("high", F.array(F.lit(_ALL))))
    first = _best(index, queries, True, positives, block, "positives").select(
        "anchor", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("_positive"))
    exact = F.col("positive_score").cast("decimal(38,0)")
    ends = first.withColumn("_low", F.ceil(exact * low / 100).cast("long")).withColumn("_high", F.floor(exact * high / 100).cast("long"))
    windows = (ends.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("_positive", "_low", "_high"))).alias("_w"))
               .select("anchor", F.col("_w._low").alias("low"), F.col("_w._high").alias("high")).where("exists(arrays_zip(low, high), w -> w.low <= w.high)"))
    all_shards = placed.groupBy("width").agg(F.array_sort(F.collect_set("shard")).alias("present"))
    # windows in the order of positives; an anchor with fewer than the others has empty ones at the end
    filled = lambda c, value: F.concat(F.col(c), F.array_repeat(F.lit(value), F.lit(positives) - F.size(c)))
    queries = (asked.join(windows, "anchor").join(all_shards, "width")
               .withColumn("low", filled("low", _ALL)).withColumn("high", filled("high", _NONE)))
    second = _best(index, queries, False, negatives, block, "negatives").select(
        "anchor", (F.col("window") + 1).alias("_positive"), F.col("other").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    return (second.join(first, ["anchor", "_positive"]).join(asked.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
