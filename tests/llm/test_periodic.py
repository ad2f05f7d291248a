"""Grammar extensions and periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import SCHEMA, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from ridgeline.llm import periodic
from ridgeline.llm.periodic import find_runs, periodic_runs
from ridgeline.llm.queries import QUERIES
from ridgeline.llm.recompression import extensions, recompress


def brute_runs(words, least=6, times=4):
    """Runs as (start, length, period): maximal stretches of equality at every distance."""
    found = {}
    n = len(words)
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if length >= max(least, times * p) and (i, length) not in found:
                found[i, length] = p
            i = j
    return sorted((s, length, p) for (s, length), p in found.items())


def collapse(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def periodic_words(rng):
    """Words with planted periodic stretches, also nested ones (a run inside each period of a longer run)."""
    k = rng.choice([1, 2, 3, 40])
    words = [rng.randrange(k) for _ in range(rng.randrange(30))]
    for _ in range(rng.randrange(4)):
        unit = [rng.randrange(k) for _ in range(rng.randrange(1, 7))]
        if rng.random() < 0.3:
            unit = unit * rng.randrange(1, 7) + [k + 1]
        words += (unit * 9)[:rng.randrange(len(unit) * 9)] + [rng.randrange(k) for _ in range(rng.randrange(5))]
    return words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=3))
def test_extensions(texts):
    sequence = [-1]
    for k, t in enumerate(texts):
        sequence += [*t, -2 - k]
    sequence = np.array(sequence)
    grammar = recompress(sequence)
    assert all((level.symbols < 0).sum() == len(texts) + 1 for level in grammar.levels)
    places = np.flatnonzero(sequence >= 0)
    i, j = (x.ravel() for x in np.meshgrid(places, places))
    i, j = i[i != j], j[i != j]
    n = len(sequence)
    after, before = extensions(grammar, i, j), extensions(grammar.mirrored(), n - i, n - j)
    for a, b, x, y in zip(i, j, after, before):
        assert (sequence[a:a + x] == sequence[b:b + x]).all() and sequence[a + x] != sequence[b + x]
        assert (sequence[a - y:a] == sequence[b - y:b]).all() and sequence[a - y - 1] != sequence[b - y - 1]


@pytest.mark.parametrize("least,times", [(6, 4), (1, 2), (10, 3)])
def test_runs(least, times, monkeypatch):
    monkeypatch.setattr(periodic, "CANDIDATES", 64)  # portions of the grid, too
    rng = random.Random(7)
    texts = [periodic_words(rng) for _ in range(120)] + [[], [1], [0] * 5, [0] * 6, [0, 1] * 4, [0, 1] * 4 + [0], [0, 0, 1] * 30]
    sizes = np.array([len(t) for t in texts])
    got = find_runs(np.array([w for t in texts for w in t]), sizes, least, times)
    want = [(k, *run) for k, t in enumerate(texts) for run in brute_runs(t, least, times)]
    assert [tuple(r) for r in got.tolist()] == want
    assert len(want) > 30


def test_operator(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{w}" for w in periodic_words(rng)) for _ in range(60)]
    texts += [None, "", " \t\n ", "a " * 30000, "é\x0bé\x0cé\ré é\té\né", "x x x x x x x x x x x x", "X x X x X x X x", "a b " * 3,
              " ".join(f"v{i}" for i in range(50000)), " ".join([*(f"v{i}" for i in range(3000))] * 5)]
    ids = [None, *range(1, len(texts) - 1), 1]
    out = periodic_runs(frame(spark, texts, ids=ids).repartition(3)).collect()
    assert len(out) == len(texts)
    long = {(i, t): [(0, 15000, 3000)] for i, t in zip(ids, texts) if t and len(t) > 70000 and t.startswith("v0 ") and t.count("v0 ") == 5}
    want = []
    for i, t in zip(ids, texts):
        words = (t or "").encode().split()
        if len(words) > 20000:
            runs = [(0, 30000, 1)] if words[0] == b"a" else []
        else:
            runs = long[i, t] if (i, t) in long else brute_runs(words)
        want.append((i, len(words), runs, b" ".join(collapse(words, runs)).decode()))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def contract_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest())


def test_query(spark, tmp_path):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rng = random.Random(5)
    extra = [(10_000 + i, " ".join(f"w{w}" for w in periodic_words(rng)), None, None, None) for i in range(300)]
    extra += [(20_000, None, None, None, None), (20_001, "", None, None, None)]
    base.union(spark.createDataFrame(extra, base.schema)).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))
                 for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect())
    want = sorted(contract_row(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect())
    assert got == want
    assert sum(r[1] > 0 for r in want) > 50
