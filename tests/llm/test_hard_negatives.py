"""Hard negatives and the hyperplane tree against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.llm.hard_negatives import mine_negatives
from ridgeline.llm.hyperplane_tree import Search, Tree, scan
from ridgeline.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, score long, anchor string, shard string, part int"


def table(spark, rows):
    """Embeddings with extra columns that clash with names used inside the operator."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)


def brute(rows, every, k=5, low=80, high=100, scale=256.0):
    members = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = tuple(math.floor(x * scale) for x in vector)
        if sum(x * x for x in v) < 1 << 62:
            members.append((i, label, v))
    members = sorted(set(members))
    out = []
    for i, label, v in members:
        if i % every:
            continue
        others = [(sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in members if j != i and len(w) == len(v)]
        others.sort(key=lambda o: (-o[0], o[1]))
        for score, j, _ in [o for o in others if o[2] == label][:k]:
            window = [o for o in others if o[2] != label and low * score <= 100 * o[0] <= high * score][:k]
            out += [(i, j, r + 1, n, score, s) for r, (s, n, _) in enumerate(window)]
    return sorted(out)


def clustered(rng, n, dims, labels, noise):
    centres = rng.normal(size=(12, dims))
    x = centres[rng.integers(0, 12, n)] + noise * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(int(i), [float(f) for f in v], int(rng.integers(labels))) for i, v in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("noise", [0.05, 0.5, 5.0])
def test_tree(noise):
    rng = np.random.default_rng(1)
    x = np.floor(256 * np.array([v for _, v, _ in clustered(rng, 3000, 8, 3, noise)]))
    x[700:1400] = x[3]  # equal vectors: no split point parts them
    label = rng.integers(0, 3, len(x))
    q = x[::40]
    high = np.sort(rng.integers(20_000, 66_000, (len(q), 3)).astype(np.float64), axis=1)
    low = np.floor(0.8 * high)
    low[5], high[5] = -np.inf, np.inf
    low[6], high[6] = 9e18, -9e18

    def allowed(asks, at):
        return label[::40][asks][:, None] != label[at][None, :]

    search = Search(Tree(x, float((x * x).sum(axis=1).max())), q, low, high, 4, allowed)
    got = sorted(zip(*(c.tolist() for c in search.run())))
    bounds = np.clip(low, -9e18, 9e18).astype(np.int64), np.clip(high, -9e18, 9e18).astype(np.int64)
    assert got == sorted(zip(*(c.tolist() for c in scan(x, q, *bounds, 4, allowed))))
    want = []
    score = q @ x.T
    for i in range(len(q)):
        for w in range(3):
            fine = [j for j in range(len(x)) if label[j] != label[40 * i] and low[i, w] <= score[i, j] <= high[i, w]]
            want += [(i, w, int(score[i, j]), j) for j in sorted(fine, key=lambda j: (-score[i, j], j))[:4]]
    assert got == sorted(want)
    if noise < 0.1:
        assert search.seen < 0.8 * len(q) * len(x)  # subtrees are passed over


@pytest.mark.parametrize("part,block,routes", [(8192, 2048, 256), (64, 16, 6)])
def test_operator(spark, part, block, routes):
    rng = np.random.default_rng(2)
    rows = clustered(rng, 700, 6, 3, 0.3)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(150)]  # equal vectors, anchors among them
    rows += [(2000 + i, [float(i % 5), 1.0], 0 if i % 3 else 7) for i in range(40)]  # another length
    rows += [(3000 + i, [], i % 2) for i in range(12)]
    rows += [(4000, [1e-9] * 6, 1), (4010, [-0.0] * 6, 1), (4020, [0.3] * 6, 99), (4030, [-1.0] * 6, 2),
             (4040, None, 1), (4050, [None] + [0.1] * 5, 1), (4060, [math.nan] * 6, 1), (4070, [math.inf] * 6, 1), (4080, [0.2] * 6, None),
             (None, [0.2] * 6, 1), (4090, [1e300] * 6, 1)]
    rows += [(5000 + 10 * i, [1e6 + i, 5.0 * i, 0.0, 1.0, 2.0, -3.0], i % 2) for i in range(30)]  # beyond exact float sums
    rows += rows[:5] + [(10, rows[20][1], 1), (10, rows[30][1], 2), (-50, rows[3][1], 0)]
    got = mine_negatives(table(spark, rows).repartition(4), F.col("vec_id") % 10 == 0, part=part, block=block, routes=routes).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10)
    assert len({r.anchor_id for r in got}) > 60


def test_other_parameters(spark):
    rows = clustered(np.random.default_rng(4), 300, 5, 2, 0.2)
    got = mine_negatives(table(spark, rows), F.col("vec_id") % 20 == 0, positives=3, negatives=3, low=50, high=95, scale=1000.0, part=50).collect()
    assert sorted(map(tuple, got)) == brute(rows, 20, 3, 50, 95, 1000.0)


def test_empty(spark):
    assert mine_negatives(table(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    assert mine_negatives(table(spark, [(0, [1.0], 1)]), F.col("vec_id") % 10 == 0).collect() == []


def test_query(spark, duck):
    d = "/root/testdata/sf0.1"
    got = QUERIES["op12_hard_negatives"](spark, d)
    want = duck(d).execute(ORACLE["op12_hard_negatives"])
    names = [c[0] for c in want.description]
    assert names == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_random_seed_is_fixed():
    x = np.floor(np.random.default_rng(0).normal(size=(2000, 4)) * 100)
    trees = [Tree(x, float((x * x).sum(axis=1).max())).root[0] for _ in range(2)]
    assert (trees[0] == trees[1]).all()
