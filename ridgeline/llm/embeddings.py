"""Near-duplicate embeddings by a flat, robust-pruned neighbour graph.

Vectors are compared only within their label.  Equal vectors are one member with a number of
copies.  Per label, centroids are fitted on a bounded sample; those nearer to each other than
the link radius make one shard, so that no dense group is torn apart.  Every member lies in its
two nearest shards, so shards overlap.

1. Build: each shard finds candidate neighbours of its members and prunes them robustly (a
   candidate goes if a kept neighbour is closer to it, by ``ALPHA``, than the member is).
2. Union: a member's adjacency lists of all its shards are joined.
3. Search: in each of its shards, every member searches greedily from the shard's medoid over
   the joined lists; once the beam is settled it expands whatever is found within the range
   until nothing new appears.
4. Verify: the cosine of a found pair is computed in double precision.
5. Audit: every member whose id is divisible by ``AUDIT`` is compared with all members of its
   label, in blocks; the share of its links that the search found is the recall.
6. Exact search: a label of which the audit knows a link that the search did not find is
   compared all against all, part by part, in matrix products of bounded tasks.

A shard of more than ``2 * SHARD`` members is split into parts by a hash; each part has a graph,
and the members of the other parts only search it, dealt into blocks of ``QUERIES``.  A task
holds one part and one block, and counts links in a matrix of bits: its size is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import written
from ridgeline.llm.graph import components

#: Rows per label that centroids are fitted on, and most centroids of a label.
SAMPLE, CENTROIDS = 4_096, 256
#: Members per shard part, aimed at.
SHARD = 1_024
#: Members that search a part in one task, aimed at.
QUERIES = 4_096
#: Neighbours of a node, candidates for them, and the pruning factor.
DEGREE, POOL, ALPHA = 16, 48, 1.2
#: Random links of a node besides its pruned ones.
FAR = 4
#: Beam of the greedy search, and how far below the range an expanded node may be.
BEAM, SLACK = 16, 0.05
#: A query that found more than this many within the range is compared with its whole part.
DENSE = 64
#: Ids divisible by this are audited; members per block of the audit.
AUDIT, BLOCK = 50, 4_096


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _matrix(column: pd.Series) -> np.ndarray:
    return _unit(np.stack(column.to_numpy()).astype(np.float64))


def members(rows: DataFrame, audit: int) -> DataFrame:
    """``label, embedding, vec_id, copies, audited, width`` of the distinct comparable vectors (``vec_id``: the smallest)."""
    numbers = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"),
                          F.col("label").cast("long").alias("label"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0.0)
    return (numbers.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .where(fine & some).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
            .groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count_distinct("vec_id").alias("copies"),
                                              F.max(F.pmod("vec_id", F.lit(audit)) == 0).alias("audited"))
            .withColumn("width", F.size("embedding")))


def _merged(centre: np.ndarray, limit: float) -> np.ndarray:
    """Shard of every centroid: those whose cosine is ``limit`` or more, in chains, share one."""
    shard = np.arange(len(centre))
    for i, row in enumerate(centre @ centre.T >= limit):
        found = np.unique(shard[row])
        shard[np.isin(shard, found)] = found.min(initial=shard[i])
    return shard


def _centroids(rows: pd.DataFrame, limit: float) -> pd.DataFrame:
    """Spherical k-means of one label's sample; one row a centroid."""
    rows = rows.sort_values("vec_id")
    x = _matrix(rows["embedding"])
    k = int(rows["wanted"].iloc[0])
    rng = np.random.default_rng(0)
    centre = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))]
    for _ in range(8):
        near = (x @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        norm = np.sqrt((total * total).sum(axis=1))
        centre = np.where(norm[:, None] > 1e-12, total / np.maximum(norm, 1e-12)[:, None], centre)
    return pd.DataFrame({"label": rows["label"].iloc[0], "width": rows["width"].iloc[0],
                         "shard": _merged(centre, limit), "centre": list(centre)})


def assign(found: DataFrame, centroids: int, shard: int, sample: int, limit: float) -> DataFrame:
    """``found`` with ``shards``: the numbers of each member's two nearest shards (one if there is one)."""
    group = ["label", "width"]
    wanted = found.groupBy(*group).count().select(
        *group, F.least(F.lit(centroids), F.ceil(F.col("count") * 2 / shard)).cast("int").alias("wanted"),
        F.least(F.lit(1.0), F.lit(float(sample)) / F.col("count")).alias("share"))
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    wanted = wanted.where("wanted > 1")
    sampled = found.join(wanted, group).where(draw < F.col("share"))
    fitted = sampled.groupBy(*group).applyInPandas(lambda rows: _centroids(rows, limit), "label long, width int, shard int, centre array<double>")
    # only labels of more than half a shard, a centroid for every half shard at least
    table: dict[tuple, list] = {}
    for r in fitted.orderBy("label", "width", "shard").collect():
        table.setdefault((r.label, r.width), []).append((r.shard, r.centre))
    centres = {k: (np.array([n for n, _ in v]), np.array([c for _, c in v])) for k, v in table.items()}

    def nearest(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            shards = np.empty(len(part), object)
            for key, rows in part.groupby(group, sort=False).indices.items():
                if key not in centres:
                    shards[rows] = [[0]] * len(rows)
                    continue
                of, centre = centres[key]
                x = _matrix(part["embedding"].iloc[rows])
                numbers, first = np.unique(of, return_index=True)  # centroids are in the order of their shards
                order = np.argsort(-np.maximum.reduceat(x @ centre.T, first, axis=1), axis=1, kind="stable")[:, :2]
                for i, o in zip(rows, np.sort(numbers[order], axis=1)):
                    shards[i] = o.tolist()
            yield part.assign(shards=shards)

    return found.mapInPandas(nearest, "label long, embedding array<double>, vec_id long, copies long, audited boolean, width int, shards array<int>")


def _prune(x: np.ndarray) -> list[np.ndarray]:
    """Robust-pruned neighbours of every row of ``x`` among its nearest rows, and random ones, with reverse edges."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    pool = min(POOL, n - 1)
    edges: list[set] = [set() for _ in range(n)]
    for low in range(0, n, 256):
        own = np.arange(low, min(low + 256, n))
        near = 1.0 - x[own] @ x.T
        near[np.arange(len(own)), own] = np.inf
        candidate = np.argpartition(near, pool - 1, axis=1)[:, :pool]
        candidate = np.take_along_axis(candidate, np.argsort(np.take_along_axis(near, candidate, 1), axis=1, kind="stable"), 1)
        to_own = np.take_along_axis(near, candidate, 1)
        between = 1.0 - np.einsum("nid,njd->nij", x[candidate], x[candidate])
        alive = np.ones(candidate.shape, bool)
        for step in range(min(DEGREE, pool)):
            some = alive.any(axis=1)
            if not some.any():
                break
            first = alive.argmax(axis=1)
            rows = np.flatnonzero(some)
            for r in rows:
                edges[own[r]].add(int(candidate[r, first[r]]))
            gap = between[np.arange(len(own)), first]
            alive &= ~((ALPHA * gap <= to_own) & some[:, None])
            alive[rows, first[rows]] = False
    # links to a few members at random, as the graph would start with: no dense group is cut off
    far = np.random.default_rng(0).integers(0, n, (n, FAR))
    for i in range(n):
        edges[i].update(far[i][far[i] != i].tolist())
    for i in range(n):
        for j in list(edges[i]):
            edges[j].add(i)
    return [np.array(sorted(e), np.int64) for e in edges]


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", ignore_index=True)
    ids = rows["vec_id"].to_numpy()
    return pd.DataFrame({"vec_id": ids, "near": [ids[e].tolist() for e in _prune(_matrix(rows["embedding"]))]})


def _search(x: np.ndarray, near: list[np.ndarray], queries: np.ndarray, limit: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each query row: the nodes that a range-expanding greedy search from the medoid visits within the limit."""
    n = len(x)
    width = max((len(e) for e in near), default=0)
    table = np.full((n, max(width, 1)), -1, np.int64)
    for i, e in enumerate(near):
        table[i, :len(e)] = e
    centre = x.mean(axis=0)
    medoid = int((x @ centre).argmax())
    for low in range(0, len(queries), 256):
        q = queries[low:low + 256]
        own = np.arange(len(q))
        known = np.full((len(q), n), -np.inf)
        known[:, medoid] = q @ x[medoid]
        waiting = known.copy()
        found = np.zeros(len(q), np.int64)
        active = own
        while len(active):
            pick = waiting[active].argmax(axis=1)
            best = waiting[active, pick]
            beam = known[active]
            floor = np.partition(beam, n - BEAM, axis=1)[:, n - BEAM] if n > BEAM else np.full(len(active), -np.inf)
            go = (best > -np.inf) & ((best >= floor) | (best >= limit - SLACK))
            active, pick = active[go], pick[go]
            if not len(active):
                break
            waiting[active, pick] = -np.inf
            nodes = table[pick]
            row = np.repeat(active, nodes.shape[1])
            flat = nodes.reshape(-1)
            fresh = (flat >= 0) & (known[row, flat] == -np.inf)
            row, flat = row[fresh], flat[fresh]
            value = np.einsum("ij,ij->i", q[row], x[flat])
            known[row, flat] = value
            waiting[row, flat] = value
            np.add.at(found, row, value >= limit)
            dense = found[active] > DENSE
            if dense.any():
                known[active[dense]] = q[active[dense]] @ x.T
                active = active[~dense]
        for k in own:
            yield low + int(k), np.flatnonzero(known[k] >= limit)


def _search_part(limit: float, exact: bool = False):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Links of one block of queries with one part of targets: per query the number of copies it links with, and spanning links."""
        rows = rows.sort_values(["target", "vec_id"], ascending=[False, True], ignore_index=True)
        inside = int(rows["target"].sum())
        asks = np.flatnonzero(rows["asks"].to_numpy())
        if not inside or not len(asks):
            return pd.DataFrame({"vec_id": [], "links": [], "other": []})
        ids, copies = rows["vec_id"].to_numpy(), rows["copies"].to_numpy().astype(np.float64)
        first = np.array([s[0] for s in rows["shards"]])
        shard = int(rows["shard"].iloc[0])
        x = _matrix(rows["embedding"])
        place = {v: i for i, v in enumerate(ids[:inside].tolist())}
        near = [np.array([place[v] for v in (e if e is not None else []) if v in place], np.int64) for e in rows["near"][:inside]]
        hit = np.zeros((len(asks), inside), bool)
        if exact:
            for low in range(0, len(asks), 256):
                hit[low:low + 256] = x[asks[low:low + 256]] @ x[:inside].T >= limit
        else:
            for k, hits in _search(x[:inside], near, x[asks], limit):
                hit[k, hits] = True
        own = np.flatnonzero(asks < inside)  # queries that are targets, too: a pair found from either side counts for both
        square = hit[np.ix_(own, asks[own])]
        hit[np.ix_(own, asks[own])] = square | square.T
        hit[own, asks[own]] = False
        links = np.zeros(len(asks))
        for low in range(0, len(asks), 256):
            q = asks[low:low + 256]
            # a pair that shares two shards counts in the first one
            counts = hit[low:low + 256] & ((first[q][:, None] != first[None, :inside]) | (first[q] == shard)[:, None])
            links[low:low + 256] = counts @ copies[:inside]
        hit[own, asks[own]] = True
        joined = _spanning(hit, asks, ids, inside)
        some = np.flatnonzero(links)
        return pd.concat([
            pd.DataFrame({"vec_id": ids[asks[some]], "links": links[some].astype(np.int64), "other": pd.array([None] * len(some), "Int64")}),
            pd.DataFrame({"vec_id": [a for a, _ in joined], "links": 0, "other": pd.array([b for _, b in joined], "Int64")})])

    return run


def _spanning(hit: np.ndarray, asks: np.ndarray, ids: np.ndarray, inside: int) -> list[tuple[int, int]]:
    """Pairs of ids that connect what the rows of ``hit`` (queries by targets) connect, at most one a query and one a target."""
    part = np.arange(inside)
    joined = []
    for k, q in enumerate(asks.tolist()):
        j = np.flatnonzero(hit[k])
        if not len(j):
            continue
        if q >= inside:
            joined.append((ids[q], ids[j[0]]))
        found, at = np.unique(part[j], return_index=True)
        if len(found) > 1:
            joined += [(ids[j[i]], ids[j[at[0]]]) for i in at[1:].tolist()]
            part[np.isin(part, found)] = found[0]
    return joined


def _audit_block(limit: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        query = rows["query"].to_numpy()
        x, ids, copies = _matrix(rows["embedding"]), rows["vec_id"].to_numpy(), rows["copies"].to_numpy()
        out = np.zeros(int(query.sum()), np.int64)
        against = x[~query]
        for low in range(0, len(out), 256):
            part = np.flatnonzero(query)[low:low + 256]
            hit = (x[part] @ against.T >= limit) & (ids[part][:, None] != ids[~query][None, :])
            out[low:low + 256] = hit @ copies[~query]
        return pd.DataFrame({"vec_id": ids[query], "audit": out})

    return run


def _blocks(graph: DataFrame, asked: Column) -> DataFrame:
    """Rows of every task ``(to, block)``: the targets of part ``to``, and a block of its shard's members that ask them.

    Members of other parts ask a part where ``asked`` holds.
    """
    own = F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.col("blocks")).cast("int")
    targets = (graph.withColumn("to", F.col("part")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .withColumn("target", F.lit(True)).withColumn("asks", F.col("block") == own))
    others = (graph.where("parts > 1").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where(asked)
              .withColumn("block", own).withColumn("target", F.lit(False)).withColumn("asks", F.lit(True))
              .withColumn("near", F.lit(None).cast("array<long>")))
    return targets.unionByName(others)


def _exact(found: DataFrame, limit: float) -> DataFrame:
    """Links of whole labels: every member is compared with every part of its label."""
    group = ["label", "width"]
    parts = found.groupBy(*group).count().select(*group, F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    rows = (found.join(parts, group).withColumn("blocks", F.col("parts"))
            .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
            .withColumn("shard", F.lit(0)).withColumn("shards", F.array(F.lit(0))).withColumn("near", F.lit(None).cast("array<long>")))
    links = (_blocks(rows, F.col("part") != F.col("to")).groupBy(*group, "to", "block")
             .applyInPandas(_search_part(limit, exact=True), "vec_id long, links long, other long"))
    return links.withColumn("exact", F.lit(True))


def _counted(links: DataFrame) -> DataFrame:
    """``vec_id, links``: by the exact search where there was one, which finds what the graph found and more."""
    return (links.where("other IS NULL").groupBy("vec_id", "exact").agg(F.sum("links").alias("links"))
            .groupBy("vec_id").agg(F.max("links").alias("links")))


def near_vectors(rows: DataFrame, limit: float = 0.98, shard: int = SHARD, centroids: int = CENTROIDS,
                 sample: int = SAMPLE, audit: int = AUDIT) -> DataFrame:
    """``vec_id, n_links, component_id, kept, audit_links`` of every row of ``rows``.

    Links join vectors of one label whose cosine is ``limit`` or more; ``component_id`` is the
    smallest ``vec_id`` reachable.  ``audit_links`` is the number of links by brute force, for
    ids divisible by ``audit`` (else null).  Vectors that are null, zero, or hold null or
    non-finite components, or whose label or id is null, link with nothing (a null id has a null
    component and is kept); so do vectors of different length.  Rows that repeat an id and its
    vector are one vector.  An empty table gives no rows; other columns are not read.
    """
    if not rows.take(1):
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, n_links long, component_id long, kept boolean, audit_links long")
    found = written(members(rows, audit), "vectors")
    group = ["label", "width"]
    placed = written(assign(found, centroids, shard, sample, limit), "shards")
    in_shards = placed.withColumn("shard", F.explode("shards"))
    key = [*group, "shard"]
    parts = in_shards.groupBy(*key).count().select(*key, F.ceil(F.col("count") / (2 * shard)).cast("int").alias("parts"),
                                                   F.ceil(F.col("count") / QUERIES).cast("int").alias("blocks"))
    dealt = (in_shards.join(parts, key).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")))
    lists = (dealt.groupBy(*key, "part").applyInPandas(_build, "vec_id long, near array<long>")
             .groupBy("vec_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near")))
    graph = written(dealt.join(lists, "vec_id"), "graph")
    searching = _blocks(graph, F.col("part") != F.col("to"))
    links = written(searching.groupBy(*key, "to", "block").applyInPandas(_search_part(limit), "vec_id long, links long, other long")
                    .withColumn("exact", F.lit(False)), "links")
    blocks = found.groupBy(*group).count().select(*group, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"),
                                              F.ceil(F.col("count") / (BLOCK * audit)).cast("int").alias("groups"))
    all_rows = found.join(blocks, group).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    asked = all_rows.where("audited")
    # the audited members, a fixed share of all, meet every block of their label
    asked = (asked.withColumn("asked", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.col("groups")).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("query", F.lit(True)))
    others = (all_rows.withColumn("asked", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
              .withColumn("query", F.lit(False)))
    audited = (asked.unionByName(others).select(*group, "asked", "block", "query", "vec_id", "copies", "embedding")
               .groupBy(*group, "asked", "block").applyInPandas(_audit_block(limit), "vec_id long, audit long")
               .groupBy("vec_id").agg(F.sum("audit").alias("audit")))
    audited = written(audited, "audit")
    # labels of which the audit knows more links than the search found
    short = written(found.join(audited, "vec_id").join(_counted(links), "vec_id", "left")
                    .where(F.coalesce("links", F.lit(0)) < F.col("audit")).select(*group).distinct(), "short")
    if short.take(1):
        links = links.unionByName(written(_exact(found.join(short, group), limit), "exact"))
    counted = _counted(links)
    named = components(links.where("other IS NOT NULL").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    result = (found.join(counted, "vec_id", "left").join(named.withColumnRenamed("node", "vec_id"), "vec_id", "left")
              .join(audited, "vec_id", "left")
              .select("label", "embedding", F.col("vec_id").alias("_rep"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
                      F.coalesce("component", "vec_id").alias("_component"), (F.col("audit") + F.col("copies") - 1).alias("_audit")))
    each = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.transform(F.col("embedding").cast("array<double>"), lambda v: v + F.lit(0.0)).alias("embedding"))
    out = each.join(result, ["label", "embedding"], "left")
    mine = F.col("vec_id").isNotNull()
    component = F.when(mine, F.coalesce("_component", "vec_id"))
    return out.select(
        "vec_id", F.when(mine, F.coalesce("_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
        F.when(mine & (F.pmod("vec_id", F.lit(audit)) == 0), F.coalesce("_audit", F.lit(0))).cast("long").alias("audit_links"))
