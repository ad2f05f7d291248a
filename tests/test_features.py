from pyspark.sql import functions as F

from support import SF_MID, SF_SMALL
from ridgeline.functions.columns import bucketise
from ridgeline.plans import features as FE
from ridgeline.sources import fixtures as fx


def _features(spark, d):
    return FE.build_features(fx.review(spark, d), fx.business(spark, d), fx.users(spark, d))


def test_flagship_counts_small(spark):
    f = _features(spark, SF_SMALL)
    assert len(f.columns) == 28
    r = f.agg(F.count("*").alias("n"), F.sum("is_high_star").alias("hi"),
              F.max("business_review_count").alias("mb"), F.max("user_review_count").alias("mu")).first()
    assert (r.n, r.hi, r.mb, r.mu) == (98, 40, 64, 91)
    buckets = {row.user_review_bucket: row["count"] for row in f.groupBy("user_review_bucket").count().collect()}
    assert buckets == {"low": 18, "medium": 45, "high": 35}


def test_flagship_counts_mid(spark):
    f = _features(spark, SF_MID)
    r = f.agg(F.count("*").alias("n"), F.sum("is_high_star").alias("hi")).first()
    assert (r.n, r.hi) == (10000, 3857)


def test_class_weights_balanced(spark):
    f = _features(spark, SF_SMALL)
    rows = f.groupBy("is_high_star").agg(F.count("*").alias("c"), F.first("class_weight").alias("w")).collect()
    total = sum(r.c for r in rows)
    for r in rows:
        assert abs(r.w - total / (2 * r.c)) < 1e-12
    # weighted classes balance: sum of weights per class equal
    sums = [r.c * r.w for r in rows]
    assert abs(sums[0] - sums[1]) < 1e-9


def test_absent_class_gives_null_weight(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "is_high_star int")
    out = sorted(FE.class_weights(df).collect(), key=lambda r: (r.is_high_star is None, r.is_high_star or 0))
    # n=3, two positives: 3/4 each; the NULL label falls to class 0, which has no rows -> NULL
    assert [r.class_weight for r in out] == [0.75, 0.75, None]
    mixed = spark.createDataFrame([(0,), (1,), (1,), (1,)], "is_high_star int")
    w = {r.is_high_star: r.class_weight for r in FE.class_weights(mixed).collect()}
    assert w == {0: 2.0, 1: 4 / 6}


def test_normalise_zero_max_is_null(spark):
    df = spark.createDataFrame([(0,), (0,)], "c bigint")
    assert [r.normalized_c for r in FE.normalise_max(df, ["c"]).collect()] == [None, None]
    df = spark.createDataFrame([(2,), (4,), (None,)], "c bigint")
    assert sorted(FE.normalise_max(df, ["c"]).collect(), key=lambda r: (r.c is None, r.c or 0)) == \
        [(2, 0.5), (4, 1.0), (None, None)]


def test_bucket_edges_and_null(spark):
    df = spark.createDataFrame([(9,), (10,), (49,), (50,), (None,)], "x bigint")
    out = df.select("x", bucketise("x", FE.USER_BUCKET_CUTS, FE.USER_BUCKET_NAMES).alias("b")).collect()
    assert {r.x: r.b for r in out} == {9: "low", 10: "medium", 49: "medium", 50: "high", None: "high"}


def test_target_null_goes_to_zero(spark):
    df = spark.createDataFrame([(4.0,), (3.9,), (None,)], "review_stars double")
    assert sorted(r.is_high_star for r in FE.add_target(df).collect()) == [0, 0, 1]


def test_duplicate_dimension_key_fans_out_and_null_key_drops(spark):
    from ridgeline.operators.joins import join_inner
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 20)], "id int, k int")
    dim = spark.createDataFrame([(10, "a"), (10, "b"), (None, "n")], "k int, v string")
    out = join_inner(fact, dim, "k").select("l.id", "r.v").collect()
    assert sorted((r.id, r.v) for r in out) == [(1, "a"), (1, "b")]


def test_feature_plan_scalars_are_subqueries(spark):
    """No cross join and no collect: the five scalars are one subquery."""
    f = _features(spark, SF_SMALL)
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Subquery" in plan


def test_dataframe_level_feature_helpers(spark):
    df = spark.createDataFrame([(40.123456, -73.987654, "abcd", 12)],
                               "latitude double, longitude double, text string, user_review_count bigint")
    out = FE.add_buckets(FE.add_text_length(FE.geo_grid(df))).first()
    assert (out.rounded_latitude, out.rounded_longitude, out.review_text_length, out.user_review_bucket) == \
        (40.12, -73.99, 4, "medium")
    from ridgeline.operators.metrics import prf
    r = prf(spark.createDataFrame([(1, 1), (0, 1)], "label int, prediction int")).first()
    assert (r.precision, r.recall) == (0.5, 1.0)


def test_texts_attached_last_give_the_same_table(spark, tmp_path):
    from ridgeline.operators.joins import enrich
    business, users = fx.business(spark, SF_SMALL), fx.users(spark, SF_SMALL)
    facts = fx.review_facts(spark, SF_SMALL)
    # text 0 comes twice, 1 is NULL, 2 has no row; reviews without a text id, and one review twice
    texts = fx.review_texts(spark, SF_SMALL).where("text_id <> 2").withColumn("text", F.expr("CASE WHEN text_id <> 1 THEN text END"))
    texts = texts.unionAll(spark.createDataFrame([(0, "again"), (None, "nobody's")], "text_id bigint, text string"))
    facts = facts.withColumn("text_id", F.expr("CASE WHEN review_id % 50 <> 7 THEN text_id END")).unionAll(facts.where("review_id = 3"))
    whole = facts.join(texts, "text_id").drop("text_id")
    assert sorted(map(str, enrich(facts, business, users, texts=texts).collect())) == sorted(map(str, enrich(whole, business, users).collect()))
    want = FE.build_features(whole, business, users)
    folder = str(tmp_path / "staged")
    got = FE.build_features(facts, business, users, staging=folder, texts=texts)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "text" not in spark.read.parquet(folder).columns
    for keep in (("review_id", "text"), ("review_id", "class_weight", "review_text_length")):
        for staging in (None, str(tmp_path / f"kept-{len(keep)}")):
            some = FE.build_features(facts, business, users, staging=staging, keep=keep, texts=texts)
            assert set(some.columns) == set(keep)
            assert sorted(map(str, some.collect())) == sorted(map(str, want.select(*some.columns).collect()))


def test_no_join_before_the_last_shuffles_the_text(spark):
    from ridgeline.registry import QUERIES
    plan = QUERIES["star_enrich"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # the topmost join's right side reads the texts; below its left side, the other joins have none
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    joins = [i for i, line in enumerate(plan) if "Join Inner" in line]
    right = max(i for i, line in enumerate(plan) if line[depth(line) - 3:].startswith("+- ") and depth(line) == depth(plan[joins[0]]) + 3)
    assert len(joins) == 3 and joins[-1] < right
    assert not any("text#" in line.split("Relation")[0] for line in plan[joins[0] + 1:right])


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def test_of_a_text_that_is_not_kept_only_the_length_is_joined(spark):
    keep = ["review_id", "review_text_length", "user_review_bucket"]
    reviews, texts = fx.review_facts(spark, SF_SMALL), fx.review_texts(spark, SF_SMALL)
    f = FE.build_features(reviews, fx.business(spark, SF_SMALL), fx.users(spark, SF_SMALL), keep=keep, texts=texts)
    joins = [n for n in _nodes(f._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join"]
    sides = [side.output().mkString(" ") for n in joins for side in (n.left(), n.right())]
    assert len(joins) == 3 and any("review_text_length#" in s for s in sides)
    assert not any(a.startswith("text#") for s in sides for a in s.split())


def test_scalars_of_staged_features_are_written_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 10, 5.0, 0), (2, 2, 10, 5.0, 1), (3, 1, 20, 1.0, 0), (4, 1, None, 1.0, 0)],
                                 "review_id bigint, user_id bigint, business_id bigint, stars double, text_id bigint")
    reviews = rows.selectExpr("*", "0L AS useful", "0L AS funny", "0L AS cool", "'d' AS date")
    business = spark.createDataFrame([(10, 4), (20, 8)], "business_id bigint, review_count bigint").selectExpr(
        "*", "1.0D AS stars", "1L AS is_open", "0.0D AS latitude", "0.0D AS longitude")
    users = spark.createDataFrame([(1, 3), (2, 6)], "user_id bigint, review_count bigint").selectExpr(
        "*", "1.0D AS average_stars", "0L AS fans", "0L AS cool", "0L AS funny", "0L AS useful")
    texts = spark.createDataFrame([(0, "ab"), (1, None)], "text_id bigint, text string")
    folder = str(tmp_path / "staged")
    f = FE.build_features(reviews, business, users, staging=folder, texts=texts)
    assert [tuple(r) for r in spark.read.parquet(f"{folder}-scalars").select("n", "n_pos", "n_neg", "max_0", "max_1").collect()] == [(3, 2, 1, 8, 6)]
    # whoever reads the features joins the texts, and nothing for the scalars
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1
    assert sorted((r.review_id, r.class_weight, r.normalized_user_review_count, r.review_text_length) for r in f.collect()) == \
        [(1, 0.75, 0.5, 2), (2, 0.75, 1.0, None), (3, 1.5, 0.5, 2)]
