"""Property tests (hypothesis): operators against brute force on random small inputs."""

import itertools

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ridgeline.operators import histogram as H
from ridgeline.operators import metrics as M

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

labelled = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20).map(lambda v: v / 20)), min_size=2, max_size=60)


def _brute_auc(rows):
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    if not pos or not neg:
        return None
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


@SETTINGS
@given(rows=labelled)
def test_auc_exact_is_mann_whitney(spark, rows):
    got = M.auc_exact(spark.createDataFrame(rows, "label int, score double")).first().auc
    want = _brute_auc(rows)
    assert (got is None and want is None) or abs(got - want) < 1e-12


@SETTINGS
@given(xs=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=80),
       k=st.integers(1, 12))
def test_fixed_bins_cover_every_value(spark, xs, k):
    out = H.histogram(spark.createDataFrame([(x,) for x in xs], "v double"), "v", k).collect()
    assert len(out) == k and sum(r.n for r in out) == len(xs)
    bins = sorted(out, key=lambda r: r.bin)
    assert bins[0].lo <= min(xs) and bins[-1].hi >= max(xs)  # last edge is exactly the max
    assert all(abs(a.hi - b.lo) < 1e-9 * max(1.0, abs(a.hi)) for a, b in zip(bins, bins[1:]))
    assert np.isfinite([r.lo for r in bins]).all()
