"""Near-duplicate vectors against brute force."""

import numpy as np
from helpers import find_components

from ridgeline.llm.embeddings import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, copies int, shard string"


def brute(rows, limit=0.98):
    good = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not np.any(v):
            continue
        good[i] = (np.array(v, np.float32).astype(np.float64), label)
    ids = sorted(good)
    edges = []
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            (x, p), (y, q) = good[i], good[j]
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= limit:
                edges.append((i, j))
    links = {i: 0 for i in ids}
    for i, j in edges:
        links[i] += 1
        links[j] += 1
    return links, find_components(ids, edges)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 1, "x")
                                  for i, v, label in rows], SCHEMA)


def corpus(n=700, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        base = rng.normal(size=16)
        rows.append((base, int(rng.integers(0, 3)) if k % 3 else 0))
        for _ in range(int(rng.integers(0, 4)) if k % 5 == 0 else 0):
            rows.append((base * rng.uniform(0.5, 2) + rng.normal(size=16) * rng.uniform(0.01, 0.2), rows[-1][1]))
    hot = rng.normal(size=16)
    rows += [(hot, 0)] * 50 + [(hot + rng.normal(size=16) * 0.05, 0) for _ in range(80)]
    rows += [(None, 0), (np.zeros(16), 0), (np.full(16, np.nan), 0), (np.full(16, np.inf), 1), ([None] * 16, 1), (hot, None), ([1.0], 0)]
    order = rng.permutation(len(rows))
    return [(int(10 * i), rows[k][0], rows[k][1]) for i, k in enumerate(order)]


def test_links_as_brute_force(spark):
    rows = corpus()
    links, component = brute(rows)
    out = near_vectors(frame(spark, rows), shard=128).collect()
    assert sorted(r.vec_id for r in out) == sorted(i for i, _, _ in rows)
    found, true = sum(r.n_links for r in out), sum(links.values())
    assert found <= true and found >= 0.99 * true
    exact = sum(r.n_links == links.get(r.vec_id, 0) and r.component_id == component.get(r.vec_id, r.vec_id) for r in out)
    assert exact >= 0.99 * len(out)
    assert all(r.n_links <= links.get(r.vec_id, 0) and r.kept == (r.vec_id == r.component_id) for r in out)
    audited = [r for r in out if r.vec_id % 50 == 0]
    assert all(r.audit_links == links.get(r.vec_id, 0) for r in audited)
    assert all(r.audit_links is None for r in out if r.vec_id % 50)


def test_odd_rows(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (7, [2.0, -0.0], 1), (None, [1.0, 0.0], 1), (9, [1.0, 0.0], 2)]
    out = near_vectors(frame(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in out) == [
        (0, 0, 0, True), (5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (9, 0, 9, True)]
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tasks_are_bounded(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ridgeline.llm import embeddings

    monkeypatch.setattr(embeddings, "QUERIES", 200)
    rng = np.random.default_rng(4)
    hot = rng.normal(size=16)
    rows = [(i, hot + rng.normal(size=16) * 0.02, 0) for i in range(1200)]  # one group that no centroid divides
    seen = []
    dealt = embeddings._blocks

    def blocks(graph, asked):
        out = dealt(graph, asked)
        seen.extend(out.groupBy("label", "shard", "to", "block").agg(F.count_if("target").alias("t"), F.count_if("asks").alias("q")).collect())
        return out

    monkeypatch.setattr(embeddings, "_blocks", blocks)
    out = near_vectors(frame(spark, rows), shard=100, centroids=1).collect()
    links, component = brute(rows)
    assert max(r.t for r in seen) <= 300 and max(r.q for r in seen) <= 300
    assert all(r.n_links == links[r.vec_id] and r.component_id == component[r.vec_id] for r in out)


def test_large_dense_group_is_whole(spark):
    rng = np.random.default_rng(6)
    hot, shift = rng.normal(size=(2, 16))
    # a group in a chain of directions, most of the label, with more centroids than it has neighbourhoods
    rows = [(i, hot + shift * rng.uniform(0, 0.3) + rng.normal(size=16) * 0.02 if i % 3 else rng.normal(size=16), 0) for i in range(1500)]
    links, component = brute(rows)
    out = near_vectors(frame(spark, rows), shard=50, centroids=60).collect()
    assert all(r.n_links == links[r.vec_id] and r.component_id == component[r.vec_id] for r in out)
    assert all(r.audit_links == r.n_links for r in out if r.vec_id % 50 == 0)
