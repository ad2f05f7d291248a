import math

from support import SF_MID, SF_SMALL
from ridgeline.operators import profile as P
from ridgeline.plans import features as FE
from ridgeline.sources import fixtures as fx


def test_null_counts_empty_is_zero(spark):
    df = spark.createDataFrame([], "a int, b double")
    assert tuple(P.null_counts(df).first()) == (0, 0)
    audit = P.null_audit(df).collect()
    assert [(r.column, r.nulls, r.null_frac) for r in audit] == [("a", 0, None), ("b", 0, None)]


def test_null_audit_counts_null_not_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    r = P.null_audit(df).first()
    assert (r.nulls, round(r.null_frac, 6)) == (1, round(1 / 3, 6))


def test_distinct_counts_null_is_one_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "b")], "x int, y string")
    got = {r.column: r.n_distinct for r in P.distinct_counts(df).collect()}
    assert got == {"x": df.select("x").distinct().count(), "y": df.select("y").distinct().count()}
    assert got == {"x": 3, "y": 3}


def test_distinct_counts_struct_and_array(spark):
    df = spark.createDataFrame([((1, "a"), [1, 2]), ((1, "a"), [1, 2]), ((2, "b"), None)],
                               "s struct<i:int,t:string>, a array<int>")
    got = {r.column: r.n_distinct for r in P.distinct_counts(df).collect()}
    assert got == {"s": 2, "a": 2}


def test_correlation_constant_is_null_and_matches_ml(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (4.0, 8.2, 5.0)],
                               "a double, b double, c double")
    got = {(r.x, r.y): r.corr for r in P.correlation_long(df).collect()}
    assert got[("a", "c")] is None and got[("c", "c")] is None
    assert abs(got[("a", "a")] - 1.0) < 1e-12
    assert abs(got[("a", "b")] - got[("b", "a")]) == 0
    import numpy as np
    expect = np.corrcoef([1, 2, 3, 4], [2.0, 4.1, 5.9, 8.2])[0, 1]
    assert abs(got[("a", "b")] - expect) < 1e-12


def test_correlation_equals_ml_on_features(spark):
    from ridgeline.plans.model import correlation_ml
    f = FE.build_features(fx.review(spark, SF_SMALL), fx.business(spark, SF_SMALL), fx.users(spark, SF_SMALL)).cache()
    a = {(r.x, r.y): r.corr for r in P.correlation_long(f).collect()}
    b = {(r.x, r.y): r.corr for r in correlation_ml(f).collect()}
    assert a.keys() == b.keys()
    for k in a:
        if a[k] is None:
            assert b[k] is None or math.isnan(b[k])
        else:
            assert abs(a[k] - b[k]) < 1e-9, k


def test_describe_numeric_matches_describe(spark):
    df = fx.review_dirty(spark, SF_SMALL)
    typed = {r.column: r for r in P.describe_numeric(df).collect()}
    d = {r.column + ":" + r.metric: r.value for r in P.describe_long(df).collect()}
    for c, r in typed.items():
        assert int(d[f"{c}:count"]) == r["count"]
        assert abs(float(d[f"{c}:mean"]) - r["mean"]) < 1e-9
        assert float(d[f"{c}:min"]) == r["min"]


def test_numeric_stats_layout(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 4.0)], "a int, b double")
    assert P.numeric_stats(df).columns == ["a_min", "b_min", "a_max", "b_max", "a_mean", "b_mean",
                                           "a_stddev", "b_stddev"]


def test_profile_long_single_pass(spark):
    df = fx.business(spark, SF_MID)
    out = P.profile_long(df, "business")
    metrics = {(r.column, r.metric) for r in out.collect()}
    assert ("name", "distinct") in metrics and ("name", "mean") not in metrics
    assert ("stars", "stddev") in metrics
    # one scan of supplier for the whole profile
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") + plan.count("Scan parquet") >= 1


def test_date_range_lexicographic(spark):
    df = spark.createDataFrame([("2018-01-02",), ("2017-12-31",), (None,)], "date string")
    r = P.date_range(df).first()
    assert (r.min_date, r.max_date) == ("2017-12-31", "2018-01-02")


def test_text_length_stats(spark):
    df = spark.createDataFrame([("ab",), ("abcd",), (None,)], "text string")
    r = P.text_length_stats(df).first()
    assert (r.min_length, r.max_length, r.mean_length) == (2, 4, 3.0)
    assert abs(r.stddev_length - math.sqrt(2)) < 1e-12


def test_missing_columns_give_empty_results(spark):
    df = spark.createDataFrame([("a",)], "name string")
    assert P.date_range(df).collect() == [] and P.text_length_stats(df).collect() == []
    assert P.describe_numeric(df).collect() == [] and P.numeric_stats(df).columns == []


def test_correlation_far_from_zero(spark):
    rows = [(1.7e9 + i % 10, 1.7e9 - i % 10, float(i % 10), 5.0) for i in range(1000)]
    got = {(r.x, r.y): r["corr"] for r in P.correlation_long(spark.createDataFrame(rows, "x double, y double, z double, c double")).collect()}
    assert abs(got["x", "y"] + 1) < 1e-9 and abs(got["x", "x"] - 1) < 1e-9 and abs(got["y", "z"] + 1) < 1e-9
    assert got["c", "x"] is None
    from ridgeline.plans.model import correlation_ml
    ml = {(r.x, r.y): r["corr"] for r in correlation_ml(spark.createDataFrame([r[:3] for r in rows], "x double, y double, z double")).collect()}
    assert all(abs(got[k] - v) < 1e-9 for k, v in ml.items())


def test_distinct_of_long_strings(spark):
    df = spark.createDataFrame([("a" * 100,), ("a" * 100,), ("a" * 99 + "b",), (None,), ("x",)], "t string")
    assert P.distinct_counts(df).first().n_distinct == 4


def test_approx_distinct_close_to_exact(spark):
    df = fx.review_dirty(spark, SF_MID)
    exact = {r.column: r.n_distinct for r in P.distinct_counts(df).collect()}
    approx = {r.column: r.n_distinct for r in P.distinct_counts(df, approx=True).collect()}
    for c, n in exact.items():
        assert abs(approx[c] - n) <= max(2, 0.15 * n), c


def test_distinct_counts_of_every_type(spark):
    rows = spark.sql("""SELECT * FROM VALUES
        (1Y, 1S, 1, 10L, 1.5F, 0.0D, 1.10BD, 'a', true, DATE'2024-01-01', TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:00', X'01', array(1), named_struct('x', 1)),
        (1Y, 1S, 2, 10L, 1.5F, -0.0D, 1.1BD, '', false, DATE'2024-01-02', TIMESTAMP'2024-01-01 00:00:00.000001', TIMESTAMP_NTZ'2024-01-02 00:00:00', X'02', array(1, 2), named_struct('x', NULL)),
        (2Y, NULL, 2, -1L, double('nan'), double('nan'), 2BD, repeat('x', 100), NULL, NULL, NULL, NULL, NULL, NULL, NULL),
        (2Y, NULL, 2, -1L, float('nan'), double('nan'), 2BD, repeat('x', 101), NULL, NULL, NULL, NULL, NULL, array(1), named_struct('x', 1))
        AS t(b, s, i, l, f, d, m, t, o, da, ts, tn, bi, ar, st)""")
    got = {r.column: r.n_distinct for r in P.distinct_counts(rows).collect()}
    assert got == {c: rows.select(c).distinct().count() for c in rows.columns}
    assert {r.column: r.n_distinct for r in P.distinct_counts(rows.limit(0)).collect()} == dict.fromkeys(rows.columns, 0)


def test_distinct_counts_shuffle_narrow_rows(spark):
    plan = P.distinct_counts(spark.range(10).selectExpr("id", "id AS b", "string(id) AS c"))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("partial_count") >= 1


def test_sketches_of_parts_equal_the_whole(spark):
    rows = spark.range(60000).selectExpr("id", "id % 7 AS few", "CASE WHEN id % 3 = 0 THEN string(id % 999) END AS t", "IF(id % 2 = 0, 0.0D, -0.0D) AS zero",
                                         "CAST(NULL AS INT) AS none", "array(id % 5) AS a")
    parts = [P.distinct_sketches(rows.where(f"id % 4 = {k}")) for k in range(4)]
    united = P.union_sketches(parts[0].union(parts[1]).union(parts[2])).union(parts[3])  # states of states, too
    got = {r.column: tuple(r)[1:] for r in P.sketch_counts(united).collect()}
    assert got == {r.column: tuple(r)[1:] for r in P.sketch_counts(P.distinct_sketches(rows)).collect()}
    exact = {r.column: r.n_distinct for r in P.distinct_counts(rows).collect()}
    assert all(abs(got[c][2] - n) <= 0.05 * n for c, n in exact.items())
    assert got["none"] == (60000, 60000, 1) and got["zero"][2] == 1
    assert {r.n_distinct for r in P.sketch_counts(P.distinct_sketches(rows.limit(0))).collect()} == {0}


def test_correlation_keeps_precision_far_from_zero(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3)) @ rng.normal(size=(3, 3))
    far = x * [1, 1e-3, 1e6] + [1.7e9, 5.0, -3e12]
    rows = spark.createDataFrame([tuple(map(float, r)) for r in far] + [(None, 1.0, 1.0)], "a double, b double, c double")
    got = {(r.x, r.y): r.corr for r in P.correlation_long(rows).collect()}
    want = np.corrcoef(far.T)
    assert all(abs(got[p, q] - want[i, j]) < 1e-7 for i, p in enumerate("abc") for j, q in enumerate("abc"))
    assert {r.corr for r in P.correlation_long(rows.limit(0)).collect()} == {None}
