import math

import pytest

from support import SF_MID, SF_SMALL
from ridgeline.operators import clean as C
from ridgeline.sources import fixtures as fx


def test_sparse_threshold_is_strict(spark):
    # 1 of 20 null = exactly 5%: kept; 2 of 20: dropped
    rows = [(i, None if i == 0 else 1, None if i < 2 else 1) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    assert C.sparse_columns(df, 0.05) == ["b"]


def test_empty_table_drops_nothing(spark):
    df = spark.createDataFrame([], "a int, b double")
    assert C.sparse_columns(df, 0.05) == []
    assert C.clean(df, "validated").count() == 0
    s = C.clean_summary(df, "validated").first()
    assert (s.rows_before, s.rows_after, s.columns_dropped) == (0, 0, 0)


def test_dropna_removes_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3), (2.0, None)], "x double, y int")
    assert [tuple(r) for r in C.drop_null_rows(df).collect()] == [(1.0, 1)]


def test_validity_edges_inclusive_and_null_drops(spark):
    rows = [(1.0, -90.0, -180.0, 0), (5.0, 90.0, 180.0, 3), (0.99, 0.0, 0.0, 1), (5.01, 0.0, 0.0, 1),
            (3.0, 90.5, 0.0, 1), (3.0, 0.0, -180.5, 1), (3.0, 0.0, 0.0, -1), (None, 0.0, 0.0, 1)]
    df = spark.createDataFrame(rows, "stars double, latitude double, longitude double, fans int")
    kept = C.validity_filter(df).collect()
    assert sorted(r.stars for r in kept) == [1.0, 5.0]


def test_validity_ignores_absent_columns(spark):
    df = spark.createDataFrame([(-5, "x")], "other int, text string")
    assert C.validity_filter(df).count() == 1


def test_normalise_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c  d` int")
    assert C.normalise_names(df).columns == ["a_b", "c__d"]


@pytest.mark.parametrize("policy,rows,dropped", [
    ("sparse20", 850, ["text"]),
    ("validated", 875, ["date", "text"]),
    ("rename", 650, []),
])
def test_policies_small(spark, policy, rows, dropped):
    df = fx.review_dirty(spark, SF_SMALL)
    out = C.clean(df, policy)
    assert out.count() == rows
    assert sorted(set(df.columns) - set(out.columns)) == dropped
    s = C.clean_summary(df, policy).first()
    assert s.rows_after == rows and s.rows_before == 1000
    assert s.dropped_columns == ",".join(dropped)


def test_policy_b_sums_mid(spark):
    from pyspark.sql import functions as F
    out = C.clean(fx.review_dirty(spark, SF_MID), "validated")
    r = out.agg(F.count("*").alias("n"), F.sum("stars").alias("s"), F.sum("useful").alias("u")).first()
    assert (r.n, r.s, r.u) == (8773, 25820.0, 25622)


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        C.clean(spark.createDataFrame([(1,)], "a int"), "nope")


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2, 1.0, 2.0, "s", True)], "a int, b bigint, c float, d double, e string, f boolean")
    assert C.numeric_columns(df) == ["a", "b", "c", "d"]
    assert C.numeric_columns(df, ("int", "double")) == ["a", "d"]
    assert not math.isnan(1.0)


def test_clean_summaries_match_each_policy(spark):
    df = spark.createDataFrame([(1, None, 3.0), (2, 5, float("nan")), (3, 6, 4.0), (None, 7, 9.0)],
                               "`a id` int, b int, stars double")
    got = {r.policy: r for r in C.clean_summaries(df).collect()}
    for p in C.POLICIES:
        assert got[p].rows_after == C.clean(df, p).count(), p
        assert got[p].rows_before == 4
