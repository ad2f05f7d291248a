import math

from support import SF_MID
from ridgeline.operators import sampling as L
from ridgeline.sources import fixtures as fx


def test_split_hash_disjoint_complete_stable(spark):
    r = fx.review(spark, SF_MID).select("review_id")
    train, test = L.split_hash(r, "review_id", 80)
    a = {x.review_id for x in train.collect()}
    b = {x.review_id for x in test.collect()}
    assert not (a & b) and len(a) + len(b) == 10000
    assert abs(len(a) / 10000 - 0.8) < 0.02
    # independent of partitioning
    a2 = {x.review_id for x in L.split_hash(r.repartition(3), "review_id", 80)[0].collect()}
    assert a == a2


def test_folds(spark):
    r = fx.review(spark, SF_MID).select("review_id")
    sizes = {x.fold: x["count"] for x in L.fold_of(r, "review_id", 5).groupBy("fold").count().collect()}
    assert set(sizes) == {0, 1, 2, 3, 4} and sum(sizes.values()) == 10000
    assert all(abs(v - 2000) < 5 * math.sqrt(2000) for v in sizes.values())


def test_sample_rows_within_five_sigma(spark):
    r = fx.review(spark, SF_MID)
    n = L.sample_rows(r, 0.1, seed=3).count()
    assert abs(n - 1000) < 5 * math.sqrt(10000 * 0.1 * 0.9)


def test_sample_fraction(spark):
    ev = fx.base(spark, SF_MID, "events")
    assert L.sample_fraction(ev, "event_id", 1.0).count() == 10000
    drawn = L.sample_fraction(ev.repartition(5), "event_id", 0.25).collect()
    assert abs(len(drawn) - 2500) < 5 * math.sqrt(10000 * 0.25 * 0.75)
    assert {r.sample_fraction for r in drawn} == {0.25}
    assert L.fraction_for_bytes(100, 100) == 1.0 and L.fraction_for_bytes(400, 100) == 0.25


def test_folds_are_independent_of_a_small_split(spark):
    r = fx.review(spark, SF_MID).select("review_id")
    train, _ = L.split_hash(r, "review_id", 3)
    assert {x.fold for x in L.fold_of(train, "review_id", 5).collect()} == {0, 1, 2, 3, 4}


def test_split_random_partitions_all_rows(spark):
    r = fx.review(spark, SF_MID).select("review_id")
    a, b = L.split_random(r, (0.8, 0.2), 42)
    assert a.count() + b.count() == 10000


def test_first_values_and_limit(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "x int")
    assert [r.x for r in L.first_values(df, "x", 2).collect()] == [1, 2]
    assert [r.x for r in L.limit_rows(df.dropna(), 1, "x").collect()] == [1]


def test_sample_exact(spark):
    import hashlib
    rows = spark.range(1000)
    order = sorted(range(1000), key=lambda i: (int(hashlib.md5(f"{i}{L.SAMPLE_SALT}".encode()).hexdigest()[:8], 16), i))
    for n in (0, 1, 137, 1000, 5000):
        for parts in (1, 7):
            assert sorted(r.id for r in L.sample_exact(rows.repartition(parts), "id", n).collect()) == sorted(order[:n])


def test_sample_bytes_measures_its_input(spark, tmp_path):
    from ridgeline.sources.io import input_bytes
    path = str(tmp_path / "t")
    spark.range(1001).repartition(3).write.parquet(path)
    size, table = input_bytes(spark, path).first().input_bytes, spark.read.parquet(path)
    assert L.sample_bytes(table, path, "id", size).count() == 1001
    assert L.sample_bytes(table, path, "id", size // 2).count() == -(-1001 * (size // 2) // size)


def test_sample_exact_sorts_the_border_only(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id % 10 > 0 THEN id % 400 END AS id", "id AS k")
    plan = L.sample_exact(rows, "id", 500)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "Limit" not in plan
    # rows without a key come first, keys that repeat are ties
    for n in (0, 40, 100, 101, 500, 999, 1000):
        got = L.sample_exact(rows.repartition(3), "id", n).collect()
        assert len(got) == len({r.k for r in got}) == n and sum(r.id is None for r in got) == min(n, 100)
