import numpy as np
import pytest

from support import SF_MID
from ridgeline.operators import histogram as H
from ridgeline.operators.ordered import exact_quantiles, running_sums


def _np_counts(x, k):
    lo, hi = float(np.min(x)), float(np.max(x))
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    b = np.minimum(np.floor((x - lo) / (hi - lo) * k).astype(int), k - 1)
    return np.bincount(b, minlength=k)


def test_fixed_bins_match_rule_and_total(spark):
    rng = np.random.default_rng(1)
    x = rng.gamma(2.0, 3.0, 5000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    out = sorted(H.histogram(df, "v", 30).collect(), key=lambda r: r.bin)
    assert len(out) == 30 and sum(r.n for r in out) == 5000
    assert [r.n for r in out] == list(_np_counts(x, 30))
    # numpy agrees except for values sitting on an edge (none here)
    np_counts, _ = np.histogram(x, bins=30)
    assert sum(abs(a - b) for a, b in zip(np_counts, [r.n for r in out])) <= 2


def test_empty_bins_emitted_and_constant_column(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (10.0,)], "v double")
    out = sorted(H.histogram(df, "v", 3).collect(), key=lambda r: r.bin)
    assert [r.n for r in out] == [2, 0, 1]
    const = spark.createDataFrame([(7.0,)] * 4, "v double")
    one = H.histogram(const, "v", "auto").collect()
    assert len(one) == 1 and one[0].n == 4 and one[0].lo == 6.5 and one[0].hi == 7.5


def test_auto_bins_match_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, 3000) ** 3
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    out = H.histogram(df, "v", "auto").collect()
    assert len(out) == len(np.histogram_bin_edges(x, bins="auto")) - 1


def test_auto_bins_events_value(spark):
    from ridgeline.sources import fixtures as fx
    out = H.histogram(fx.base(spark, SF_MID, "events"), "value", "auto").collect()
    assert len(out) == 97 and sum(1 for r in out if r.n > 0) == 71


def test_grouped_histogram_shares_edges(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1), (0.5, 1), (0.5, 0)], "p double, label int")
    out = H.histogram(df, "p", 4, by="label").collect()
    assert len(out) == 8
    edges = {(r.bin, r.lo, r.hi) for r in out}
    assert len(edges) == 4


@pytest.mark.parametrize("probs", [[0.25, 0.75], [0.0, 0.5, 1.0], [0.1, 0.9]])
def test_exact_quantiles_match_numpy(spark, probs):
    rng = np.random.default_rng(3)
    x = np.round(rng.exponential(5.0, 2001), 2)  # ties included
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = exact_quantiles(df, "v", probs, buckets=16).first()
    for i, p in enumerate(probs):
        assert abs(got[i] - np.percentile(x, 100 * p)) < 1e-9


def test_running_sums_match_cumsum(spark):
    rng = np.random.default_rng(5)
    keys = rng.permutation(3000).astype(float) * 0.37
    w = rng.integers(0, 9, 3000)
    df = spark.createDataFrame([(float(k), int(v)) for k, v in zip(keys, w)], "k double, w long")
    got = {r.k: r.cum_w for r in running_sums(df, "k", ["w"], buckets=32).collect()}
    order = np.argsort(keys)
    cum = np.cumsum(w[order])
    for i, idx in enumerate(order):
        assert got[keys[idx]] == cum[i]
    down = {r.k: r.cum_w for r in running_sums(df, "k", ["w"], descending=True, buckets=7).collect()}
    order = np.argsort(-keys)
    cum = np.cumsum(w[order])
    for i, idx in enumerate(order):
        assert down[keys[idx]] == cum[i]


def test_density_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(50, 10, 800), 1)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    out = sorted(H.density(df, "v", points=50).collect(), key=lambda r: r.point)
    h = np.std(x, ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert len(out) == 50
    for r, g, dv in zip(out, grid, dens):
        assert abs(r.x - g) < 1e-9 and abs(r.density - dv) < 1e-12


def test_density_constant_is_null(spark):
    df = spark.createDataFrame([(3.0,)] * 5, "v double")
    out = H.density(df, "v", points=5).collect()
    assert len(out) == 5 and all(r.density is None for r in out)


def test_running_sums_with_outliers_and_infinities(spark):
    rng = np.random.default_rng(9)
    keys = np.concatenate([rng.random(3000), [1e9, float("inf"), float("-inf")]])  # heavy tail, infinite keys
    df = spark.createDataFrame([(float(k), 1) for k in keys], "k double, w long")
    order = np.argsort(keys)
    for buckets in (1, 8, 100):
        got = {r.k: r.cum_w for r in running_sums(df, "k", ["w"], buckets=buckets).collect()}
        assert [got[keys[i]] for i in order] == list(range(1, len(keys) + 1))


def test_running_sums_by_group(spark):
    rows = [(g, float(i * 37 % 101), 1) for g in ("a", "b") for i in range(101)]
    out = running_sums(spark.createDataFrame(rows, "g string, k double, w long"), "k", ["w"], buckets=4, by=["g"]).collect()
    assert all(r.cum_w == r.k + 1 for r in out) and len(out) == 202


def test_infinite_values_and_null_groups(spark):
    inf = float("inf")
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 1.0), ("a", inf), ("a", -inf), ("a", 3.0)], "g string, v double")
    for bins in (4, "auto"):
        out = H.histogram(df, "v", bins, by="g").collect()
        assert sum(r.n for r in out if r.g is None) == 2 and sum(r.n for r in out if r.g == "a") == 2
    assert sum(r.n for r in H.histogram(df, "v", "auto").collect()) == 4
    curve = H.density(df, "v", points=5, by="g").collect()
    assert len(curve) == 10 and all(r.density > 0 for r in curve)


def test_density_reach_is_exact_by_default(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.2,), (1000.0,)], "v double")
    far = H.density(df, "v", points=3).collect()
    assert all(r.density > 0 for r in far)
    assert len(H.density(df, "v", points=3, reach=1.0).collect()) == 3


def test_numeric_histograms_per_column(spark):
    df = spark.createDataFrame([(float(i % 17), i, "s") for i in range(500)], "a double, b bigint, t string")
    out = H.numeric_histograms(df).collect()
    by_col = {}
    for r in out:
        by_col.setdefault(r.column, []).append(r)
    assert set(by_col) == {"a", "b"}
    for c, vals in (("a", [float(i % 17) for i in range(500)]), ("b", [float(i) for i in range(500)])):
        x = np.array(vals)
        assert len(by_col[c]) == len(np.histogram_bin_edges(x, bins="auto")) - 1
        assert sum(r.n for r in by_col[c]) == 500


def test_density_by_group_matches_brute_force(spark):
    rng = np.random.default_rng(13)
    a = np.round(rng.normal(10, 2, 300), 2)
    b = np.round(rng.normal(14, 3, 200), 2)
    rows = [(0, float(v)) for v in a] + [(1, float(v)) for v in b]
    df = spark.createDataFrame(rows, "g int, v double")
    out = H.density(df, "v", points=40, by="g").collect()
    grid = np.linspace(min(a.min(), b.min()), max(a.max(), b.max()), 40)
    for gid, x in ((0, a), (1, b)):
        h = np.std(x, ddof=1) * len(x) ** -0.2
        dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
        got = sorted((r for r in out if r.g == gid), key=lambda r: r.point)
        assert len(got) == 40
        for r, gx, dv in zip(got, grid, dens):
            assert abs(r.x - gx) < 1e-9 and abs(r.density - dv) < 1e-12


def test_all_null_column_gives_empty_results(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert H.histogram(df, "v", "auto").count() == 0
    assert H.histogram(df, "v", 10).count() == 0
    assert H.density(df, "v", points=5).count() == 0
    q = exact_quantiles(df, "v", [0.5]).first()
    assert q[0] is None


def test_ranges_balanced_on_heavy_tail(spark):
    from pyspark.sql import functions as F

    from ridgeline.operators.ordered import range_of
    rng = np.random.default_rng(21)
    keys = np.unique(np.concatenate([rng.pareto(0.7, 20000), [1e12, 1e15]]))
    edges = np.quantile(keys, np.arange(1, 16) / 16)
    df = spark.createDataFrame([(float(k),) for k in keys], "k double")
    ranged = df.withColumn("b", range_of(F.array(*[F.lit(float(e)) for e in edges]), F.col("k"), 16))
    assert all(r.b == np.searchsorted(edges, r.k, "right") for r in ranged.sample(0.1, seed=1).collect())
    sizes = [r["count"] for r in ranged.groupBy("b").count().collect()]
    assert sum(sizes) == len(keys) and len(sizes) == 16
    assert max(sizes) <= 2 * len(keys) / 16  # equal-width ranges would put nearly all in one


def test_grouped_histogram_auto_bins(spark):
    rng = np.random.default_rng(17)
    x = rng.normal(0, 1, 2000)
    rows = [(int(i % 2), float(v)) for i, v in enumerate(x)]
    out = H.histogram(spark.createDataFrame(rows, "g int, v double"), "v", "auto", by="g").collect()
    k = len(np.histogram_bin_edges(x, bins="auto")) - 1
    assert len(out) == 2 * k and sum(r.n for r in out) == 2000


def test_selection_on_all_distinct_values(spark):
    import numpy as np

    from ridgeline.operators.ordered import exact_quantiles
    probs = [0.0, 0.01, 0.25, 0.5, 0.333, 0.75, 0.99, 1.0]
    rows = spark.range(50000).selectExpr("pow(pmod(id * 7919, 50021), 3) - 1e9 AS x")
    x = np.array([r.x for r in rows.collect()])
    for ranges in (2, 50, 4096):
        got = tuple(exact_quantiles(rows, "x", probs, ranges=ranges).first())
        assert np.allclose(got, np.quantile(x, probs), rtol=1e-12, atol=0)


def test_selection_with_ties_gaps_and_few_rows(spark):
    import numpy as np

    from ridgeline.operators.ordered import exact_quantiles
    rng = np.random.default_rng(3)
    tables = [[5.0] * 300, [1.0], [1.0, 2.0], [0.0] * 900 + [1e300, -1e300, 3.5], list(rng.integers(0, 4, 500).astype(float)),
              list(np.repeat(rng.normal(size=40), rng.integers(1, 30, 40)))]
    for values in tables:
        rows = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "x double")
        got = exact_quantiles(rows, "x", [0.1, 0.25, 0.5, 0.75], ["a", "b", "c", "d"], ranges=16).first()
        assert np.allclose(tuple(got), np.quantile(values, [0.1, 0.25, 0.5, 0.75]), rtol=1e-12, atol=1e-300)
    none = exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]).collect()
    assert [tuple(r) for r in none] == [(None,)]


def test_histogram_of_staged_rows(spark, tmp_path):
    from ridgeline.operators.histogram import histogram
    rows = spark.range(2000).selectExpr("id % 97 * 1.5 AS v", "IF(id % 5 = 0, NULL, id % 3) AS g", "repeat('x', 50) AS text")
    for by in (None, "g"):
        plain = histogram(rows, "v", "auto", by)
        staged = histogram(rows, "v", "auto", by, staging=str(tmp_path / str(by)))
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, staged.collect()), key=str)
        assert spark.read.parquet(str(tmp_path / str(by))).columns == ([by] if by else []) + ["x"]


def test_density_has_no_join_with_the_grid(spark):
    from ridgeline.operators.histogram import density
    rows = spark.range(3000).selectExpr("id * 0.5 AS v", "id % 2 AS g")
    for by in (None, "g"):
        out = density(rows, "v", by=by)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_density_band_changes_no_value(spark):
    import numpy as np

    from ridgeline.operators.histogram import density
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=3000) * 1e-3, [50.0, -40.0]])  # narrow bandwidth, points far from every value
    got = [r.density for r in density(spark.createDataFrame([(float(v),) for v in x], "v double"), "v", points=60).orderBy("point").collect()]
    h = x.std(ddof=1) * len(x) ** -0.2
    at = np.linspace(x.min(), x.max(), 60)
    want = np.exp(-0.5 * ((at[:, None] - x[None]) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.allclose(got, want, rtol=1e-9, atol=1e-300)
