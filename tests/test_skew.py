"""A hot key holding a third of the fact rows: the star join stays correct and AQE
splits the skewed partition instead of sending it to one task."""

from pyspark.sql import functions as F

from ridgeline.operators.joins import enrich


def _frames(spark, n=30000):
    reviews = spark.range(n).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("business_id"),
        (F.col("id") % 500).alias("user_id"),
        (F.col("id") % 5 + 1).cast("double").alias("stars"),
        F.lit("some text").alias("text"), F.lit("2020-01-01").alias("date"),
        F.lit(0).cast("bigint").alias("cool"), F.lit(0).cast("bigint").alias("funny"),
        F.lit(0).cast("bigint").alias("useful"),
    )
    business = spark.range(1000).select(
        F.col("id").alias("business_id"), F.lit(3.0).alias("stars"), F.lit(1).cast("bigint").alias("is_open"),
        F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.col("id").alias("review_count"))
    users = spark.range(500).select(
        F.col("id").alias("user_id"), F.lit(3.5).alias("average_stars"), F.col("id").alias("review_count"),
        F.lit(1).cast("bigint").alias("fans"), F.lit(0).cast("bigint").alias("cool"),
        F.lit(0).cast("bigint").alias("funny"), F.lit(0).cast("bigint").alias("useful"))
    return reviews, business, users


def test_hot_key_split_by_aqe(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = enrich(*_frames(spark))
        agg = out.groupBy("business_id").count()
        hot = {r.business_id: r["count"] for r in agg.collect()}
        expect_hot = sum(1 for i in range(30000) if i % 3 == 0 or i % 1000 == 7)
        assert hot[7] == expect_hot and sum(hot.values()) == 30000
        assert len(out.collect()) == 30000  # runs this DataFrame's own adaptive plan
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_star_join_shuffles_the_fact_once(spark):
    from ridgeline.plans.features import build_features
    from ridgeline.session import scratch_path
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        out = build_features(*_frames(spark, 3000), staging=scratch_path(spark, "star"))
        assert "Join" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 3000
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)


def test_salted_star_join_equals_plain(spark):
    r, b, u = _frames(spark, 6000)
    plain = sorted(tuple(x) for x in enrich(r, b, u).collect())
    salted = sorted(tuple(x) for x in enrich(r, b, u, salts=8).collect())
    assert plain == salted and len(plain) == 6000


def test_salted_join_spreads_hot_key(spark):
    from ridgeline.operators.joins import salted
    r, b, _ = _frames(spark, 30000)
    f, d = salted(r, b, 8, "review_id")
    per_salt = {x._salt: x["count"] for x in f.filter("business_id = 7").groupBy("_salt").count().collect()}
    assert len(per_salt) == 8 and max(per_salt.values()) < 2 * (sum(per_salt.values()) / 8)
    assert d.count() == 8 * b.count()
