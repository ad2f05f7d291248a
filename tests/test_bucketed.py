"""Bucketed layout: the star join without an exchange on the fact table."""

import re

from support import SF_SMALL
from ridgeline.operators.joins import bucketed_star, enrich
from ridgeline.sources import fixtures as fx
from ridgeline.sources import io as IO


def tables(spark):
    return fx.review(spark, SF_SMALL), fx.business(spark, SF_SMALL), fx.users(spark, SF_SMALL)


def test_star_join_has_no_exchange_on_the_fact(spark, tmp_path):
    want = sorted(map(tuple, enrich(*tables(spark)).collect()))
    stored = bucketed_star(*tables(spark), str(tmp_path / "star"), "star_test", 4)
    assert IO.input_bytes(spark, str(tmp_path / "star" / "reviews")).first().input_files == 4
    sizes = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        # business is broadcast, the users are too large for it
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        for again in range(2):
            out = enrich(stored[0], stored[1].hint("broadcast"), stored[2].hint("merge"))
            assert sorted(map(tuple, out.collect())) == want
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and not re.search(r"Exchange hashpartitioning", plan)
            assert plan.count("Bucketed: true") >= 2
    finally:
        for k, v in sizes.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for t in ("star_test_reviews", "star_test_users"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_bucketed_sink_replaces_and_keeps_every_row(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "id % 7 AS k")
    for table in (rows, rows.where("id < 100").union(rows.where("id < 100"))):
        got = IO.write_bucketed(table, "bucketed_rows", str(tmp_path / "b"), "k", 3)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, table.collect()))
    assert IO.write_bucketed(rows.limit(0), "bucketed_rows", str(tmp_path / "b"), "k", 3).count() == 0
    spark.sql("DROP TABLE IF EXISTS bucketed_rows")
