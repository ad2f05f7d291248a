"""Multiway hyperplane tree over integer vectors, searched for the highest inner products within windows.

Inner products become distances by one more component that gives every stored vector the same norm
``m`` (a query has 0 there): ``distance**2 = |query|**2 + m**2 - 2 * product``, so a window of products
is an annulus around the query.  A node holds some of its vectors as split points; every other
vector lies with its nearest one.  For each split point the node stores the smallest and largest
distance to the vectors of every sibling subtree.  With its distance to a split point, a query
knows the distances that a sibling's vectors can have; a sibling goes unseen where these do not meet
the query's annulus for some split point.  Leaves are compared exactly.

Distances only serve to pass over subtrees and are rounded outwards; products are exact, as
long as norms stay within ``TAME``.
"""

from __future__ import annotations

import numpy as np

#: Largest squared norm at which float sums of products of integers are exact.
TAME = float(1 << 52)
#: Split points of a node, and most vectors of a leaf (compared in chunks of this size, 256 at most).
FANOUT, LEAF = 16, 256
#: Distances are rounded outwards by this part of the common norm.
SLACK = 1e-6


def raised(x: np.ndarray, m2: float) -> np.ndarray:
    """The component that gives every row of ``x`` the squared norm ``m2``."""
    return np.sqrt(np.maximum(m2 - (x * x).sum(axis=1), 0.0))


def between(x: np.ndarray, extra: np.ndarray, y: np.ndarray, y_extra: np.ndarray, m2: float) -> np.ndarray:
    """Distances of stored vectors."""
    return np.sqrt(np.maximum(2.0 * (m2 - x @ y.T - extra[:, None] * y_extra[None, :]), 0.0))


def farthest_first(x: np.ndarray, extra: np.ndarray, k: int, m2: float) -> np.ndarray:
    """Up to ``k`` rows of ``x``, each the farthest from those chosen before; fewer if the others are equal to them."""
    chosen = [0]
    near = between(x, extra, x[:1], extra[:1], m2)[:, 0]
    while len(chosen) < k:
        nxt = int(near.argmax())
        if near[nxt] <= SLACK * np.sqrt(m2):
            break
        chosen.append(nxt)
        near = np.minimum(near, between(x, extra, x[nxt:nxt + 1], extra[nxt:nxt + 1], m2)[:, 0])
    return np.array(chosen)


def to_splits(q: np.ndarray, splits: np.ndarray, m2: float) -> np.ndarray:
    """Distances of queries to split points."""
    return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + m2 - 2.0 * (q @ splits.T), 0.0))


def annulus(q: np.ndarray, low: np.ndarray, high: np.ndarray, m2: float) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest distance of a stored vector whose product with a query lies in ``low..high``."""
    base = (q * q).sum(axis=1) + m2
    return np.sqrt(np.maximum(base - 2.0 * high, 0.0)), np.sqrt(np.maximum(base - 2.0 * low, 0.0))


def reachable(gap: np.ndarray, low: np.ndarray, high: np.ndarray, inner: np.ndarray, outer: np.ndarray, m2: float) -> np.ndarray:
    """Which siblings (columns) each query must see.

    ``gap``: distances of queries to the split points; ``low`` and ``high``: ranges of distances from
    every split point (rows) to every sibling's vectors (columns).
    """
    slack = SLACK * np.sqrt(m2)
    out = np.ones((len(gap), low.shape[1]), bool)
    for i in range(len(low)):
        own = gap[:, i:i + 1]
        least = np.maximum(np.maximum(low[i] - own, own - high[i]), 0.0)
        out &= (least <= outer[:, None] + slack) & (own + high[i] >= inner[:, None] - slack)
    return out


class Tree:
    """Tree over the rows of ``x`` (integers as floats, norms within ``TAME``), which are in the order of ties."""

    def __init__(self, x: np.ndarray, m2: float):
        self.x, self.m2 = x, max(m2, 1.0)
        self._extra = raised(x, self.m2)
        self._draw = np.random.default_rng(0)
        self.root = self._grow(np.arange(len(x)))

    def _grow(self, rows: np.ndarray) -> tuple:
        if len(rows) > LEAF:
            some = rows if len(rows) <= 4 * FANOUT else np.sort(self._draw.choice(rows, 4 * FANOUT, replace=False))
            splits = some[farthest_first(self.x[some], self._extra[some], FANOUT, self.m2)]
            gap = between(self.x[rows], self._extra[rows], self.x[splits], self._extra[splits], self.m2)
            owner = gap.argmin(axis=1)
            if (owner != owner[0]).any():
                low, high = np.full((len(splits), len(splits)), np.inf), np.full((len(splits), len(splits)), -np.inf)
                children = []
                for j in range(len(splits)):
                    mine = owner == j
                    if mine.any():
                        low[:, j], high[:, j] = gap[mine].min(axis=0), gap[mine].max(axis=0)
                    children.append(self._grow(rows[mine]))
                return self.x[splits], low, high, children
        return (rows,)


class Search:
    """The ``k`` highest products of each query in each of its windows, ties by row order.

    ``low`` and ``high`` hold the windows of every query, both ends included.  ``allowed(queries, rows)`` tells
    which rows (columns) may answer which queries.
    """

    def __init__(self, tree: Tree, q: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, allowed):
        self._tree, self._q, self._low, self._high, self._k, self._allowed = tree, q, low, high, k, allowed
        self._best = np.full((*low.shape, k), -np.inf)
        self._found: list[tuple] = []
        self.seen = 0

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Query, window, score and row of every answer, in no order."""
        self._visit(self._tree.root, np.arange(len(self._q)))
        self._settle()
        return self._found[0]

    def _visit(self, node: tuple, active: np.ndarray) -> None:
        if not len(active):
            return
        if len(node) == 1:
            for first in range(0, len(node[0]), LEAF):
                self._leaf(node[0][first:first + LEAF], active)
            return
        splits, low, high, children = node
        gap = to_splits(self._q[active], splits, self._tree.m2)
        nearest = gap.argmin(axis=1)
        for own in (True, False):  # the nearest sibling first, which raises what the others must reach
            inner, outer = self._annulus(active)
            see = reachable(gap, low, high, inner, outer, self._tree.m2) & ((np.arange(len(children)) == nearest[:, None]) == own)
            for j, child in enumerate(children):
                self._visit(child, active[see[:, j]])

    def _annulus(self, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        floor = np.maximum(self._low[active], self._best[active, :, 0]).min(axis=1)
        return annulus(self._q[active], floor, self._high[active].max(axis=1), self._tree.m2)

    def _leaf(self, rows: np.ndarray, active: np.ndarray) -> None:
        if not len(rows):
            return
        score = self._q[active] @ self._tree.x[rows].T
        self.seen += score.size
        fine = self._allowed(active, rows)
        least = np.iinfo(np.int64).min
        # score and place in one number: the highest score, then the first row
        key = score.astype(np.int64) * np.int64(256) + (255 - np.arange(len(rows)))
        for w in range(self._low.shape[1]):
            floor = np.maximum(self._low[active, w], self._best[active, w, 0])
            in_window = fine & (score >= floor[:, None]) & (score <= self._high[active, w][:, None])
            some = np.flatnonzero(in_window.any(axis=1))
            if not len(some):
                continue
            keys = np.where(in_window[some], key[some], least)
            if keys.shape[1] > self._k:
                keys = np.partition(keys, keys.shape[1] - self._k, axis=1)[:, -self._k:]
            at, col = np.nonzero(keys != least)
            value = keys[at, col]
            query = active[some[at]]
            self._found.append((query, np.full(len(query), w), value >> np.int64(8), rows[255 - (value & np.int64(255))]))
            scores = np.where(keys != least, (keys >> np.int64(8)).astype(np.float64), -np.inf)
            own = active[some]
            merged = np.concatenate((self._best[own, w], scores), axis=1)
            merged.sort(axis=1)
            self._best[own, w] = merged[:, -self._k:]
        if sum(len(f[0]) for f in self._found) > 1 << 20:
            self._settle()

    def _settle(self) -> None:
        """Keep the ``k`` first answers of every query and window."""
        if not self._found:
            self._found = [tuple(np.zeros(0, np.int64) for _ in range(4))]
        query, window, score, row = (np.concatenate([f[c] for f in self._found]) for c in range(4))
        keep = first_of(query * np.int64(self._low.shape[1]) + window, score, row, self._k)
        self._found = [(query[keep], window[keep], score[keep], row[keep])]


def first_of(group: np.ndarray, score: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores of every group, ties by row."""
    order = np.lexsort((row, ~score, group))  # ~score falls as score rises, without overflow
    own = group[order]
    start = np.ones(len(own), bool)
    start[1:] = own[1:] != own[:-1]
    rank = np.arange(len(own)) - np.flatnonzero(start)[np.cumsum(start) - 1] if len(own) else own
    return order[rank < k]


def scan(x: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, allowed) -> tuple[np.ndarray, ...]:
    """What :class:`Search` gives, by comparing all rows in 64-bit integers (for norms beyond ``TAME``)."""
    out = [tuple(np.zeros(0, np.int64) for _ in range(4))]
    whole = x.astype(np.int64)
    for i in range(len(q)):
        score = whole @ q[i].astype(np.int64)
        fine = allowed(np.array([i]), np.arange(len(x)))[0]
        for w in range(low.shape[1]):
            rows = np.flatnonzero(fine & (score >= low[i, w]) & (score <= high[i, w]))
            rows = rows[first_of(np.zeros(len(rows), np.int64), score[rows], rows, k)]
            out.append((np.full(len(rows), i), np.full(len(rows), w), score[rows], rows))
    return tuple(np.concatenate([f[c] for f in out]) for c in range(4))
