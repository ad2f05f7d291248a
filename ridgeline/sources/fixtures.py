"""Review-shaped fixture tables derived from the driver's test tables.

The reference reads five JSON entities (review, business, user, checkin, tip).  The
test data is a TPC-H-like star plus ``events`` and ``documents``; these views give it
the review / business / user shape.  Each view is built with the DataFrame API for
Spark and has a DuckDB twin in :data:`DUCKDB_VIEWS` for the oracle.

Every review links to a whole document: ``doc_id = event_id % count(documents)``
(ids are dense from 0), so the work grows with the whole documents table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def review_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review`` without its text: in its place ``text_id``, the key of the text in :func:`review_texts`.

    For jobs that attach the text after their other joins.  A row without a text there is none of ``review``."""
    events = base(spark, sf_dir, "events")
    n_docs = base(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()  # scalar subquery, run once
    v = F.floor(F.col("value")).cast("bigint")
    return events.select(
        F.col("event_id").alias("review_id"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("business_id"),
        (F.lit(1) + v % 5).cast("double").alias("stars"),
        (v % 7).alias("useful"),
        (v % 3).alias("funny"),
        (v % 2).alias("cool"),
        (F.col("event_id") % n_docs).alias("text_id"),
        F.col("ts").cast("string").alias("date"),
    )


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of ``review`` by ``text_id``."""
    return base(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), "text")


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact table: one row per event, key ``review_id``."""
    joined = review_facts(spark, sf_dir).join(review_texts(spark, sf_dir), "text_id")
    return joined.select("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "text", "date")


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension keyed by ``business_id``."""
    s = base(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("business_id"),
        F.col("s_name").alias("name"),
        (F.lit(1.0) + (k % 9).cast("double") / F.lit(2.0)).alias("stars"),
        F.when(k % 4 == 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("is_open"),
        (F.col("s_acctbal") / F.lit(120.0)).alias("latitude"),
        (F.col("s_acctbal") / F.lit(60.0)).alias("longitude"),
        ((k * 7) % 500 + 1).alias("review_count"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension keyed by ``user_id``."""
    c = base(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.alias("user_id"),
        (F.lit(1.0) + (k % 41).cast("double") / F.lit(10.0)).alias("average_stars"),
        ((k * 13) % 97).alias("review_count"),
        (k % 11).alias("fans"),
        (k % 5).alias("cool"),
        (k % 3).alias("funny"),
        (k % 7).alias("useful"),
    )


def review_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review`` with NULLs and invalid values injected by id pattern (no row removed)."""
    r = review(spark, sf_dir)
    rid = F.col("review_id")
    return r.select(
        "review_id", "user_id", "business_id",
        F.when(rid % 33 == 0, F.lit(9.0)).otherwise(F.col("stars")).alias("stars"),
        F.when(rid % 50 == 0, F.lit(None)).otherwise(F.col("useful")).alias("useful"),
        F.when(rid % 20 == 3, F.lit(None)).otherwise(F.col("funny")).alias("funny"),
        F.when(rid % 37 == 0, F.lit(-1)).otherwise(F.col("cool")).alias("cool"),
        F.when(rid % 4 == 0, F.lit(None)).otherwise(F.col("text")).alias("text"),
        F.when(rid % 10 == 0, F.lit(None)).otherwise(F.col("date")).alias("date"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed score per review so evaluation metrics can be checked by value."""
    r = review(spark, sf_dir).select("review_id", "stars")
    label = F.when(F.col("stars") >= 4, F.lit(1)).otherwise(F.lit(0))
    score = (
        F.when(F.col("stars") >= 4, F.lit(200)).otherwise(F.lit(0)).cast("double")
        + ((F.col("review_id") * 7919) % 800).cast("double")
    ) / F.lit(1000.0)
    return r.select(
        "review_id",
        label.alias("label"),
        score.alias("score"),
    ).withColumn("prediction", F.when(F.col("score") >= 0.5, F.lit(1)).otherwise(F.lit(0)))


def with_signal(reviews: DataFrame) -> DataFrame:
    """Reviews with stars that depend on both model features (the two review counts) and noise."""
    def part(c: str, times: int, modulus: int) -> Column:
        return (F.col(c) * times % modulus).cast("double") / F.lit(float(modulus))

    score = part("business_id", 7, 500) + part("user_id", 13, 97) + part("review_id", 7919, 1000)
    return reviews.withColumn("stars", F.when(score >= 1.5, F.lit(5.0)).otherwise(F.lit(2.0)))


def review_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review`` with the stars of :func:`with_signal`."""
    return with_signal(review(spark, sf_dir))


def business_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``business`` with a value out of range in every checked column."""
    k = F.col("business_id")
    return business(spark, sf_dir).withColumns({
        "stars": F.when(k % 23 == 0, F.lit(0.5)).otherwise(F.col("stars")),
        "latitude": F.when(k % 13 == 0, F.lit(95.0)).otherwise(F.col("latitude")),
        "longitude": F.when(k % 17 == 0, F.lit(-200.0)).otherwise(F.col("longitude")),
        "review_count": F.when(k % 19 == 0, F.lit(-5)).otherwise(F.col("review_count")).cast("bigint"),
    })


# The user table's compliment columns.
COMPLIMENTS = tuple(f"compliment_{x}" for x in (
    "cool", "cute", "funny", "hot", "list", "more", "note", "photos", "plain", "profile", "writer"))


def users_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``users`` with compliment counts, and negative values in every checked column."""
    k = F.col("user_id")
    return users(spark, sf_dir).withColumns({
        "fans": F.when(k % 29 == 0, F.lit(-1)).otherwise(F.col("fans")).cast("bigint"),
        **{c: F.when(k % (31 + i) == 0, F.lit(-1)).otherwise(k * (i + 1) % 50).cast("bigint") for i, c in enumerate(COMPLIMENTS)},
    })


def checkin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review(spark, sf_dir).select("business_id", "date")


def tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review(spark, sf_dir).select("user_id", "business_id", "text", "date", F.col("useful").alias("compliment_count"))


VIEWS = {
    "review": review,
    "review_signal": review_signal,
    "business_dirty": business_dirty,
    "users_dirty": users_dirty,
    "checkin": checkin,
    "tip": tip,
    "business": business,
    "users": users,
    "review_dirty": review_dirty,
    "scored": scored,
}


# DuckDB twins of the views above, in dependency order (used as WITH clauses).
DUCKDB_VIEWS = {
    "review": """
SELECT e.event_id AS review_id, e.user_id, CAST(e.props->>'$.k' AS BIGINT) AS business_id,
  CAST(1 + CAST(floor(e.value) AS BIGINT) % 5 AS DOUBLE) AS stars,
  CAST(floor(e.value) AS BIGINT) % 7 AS useful, CAST(floor(e.value) AS BIGINT) % 3 AS funny,
  CAST(floor(e.value) AS BIGINT) % 2 AS cool, d.text, CAST(e.ts AS VARCHAR) AS date
FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)""",
    "business": """
SELECT s_suppkey AS business_id, s_name AS name,
  CAST(1 AS DOUBLE) + CAST(s_suppkey % 9 AS DOUBLE) / CAST(2 AS DOUBLE) AS stars,
  CAST(CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS is_open,
  s_acctbal / CAST(120 AS DOUBLE) AS latitude, s_acctbal / CAST(60 AS DOUBLE) AS longitude,
  (s_suppkey * 7) % 500 + 1 AS review_count
FROM supplier""",
    "users": """
SELECT c_custkey AS user_id, CAST(1 AS DOUBLE) + CAST(c_custkey % 41 AS DOUBLE) / CAST(10 AS DOUBLE) AS average_stars,
  (c_custkey * 13) % 97 AS review_count, c_custkey % 11 AS fans,
  c_custkey % 5 AS cool, c_custkey % 3 AS funny, c_custkey % 7 AS useful
FROM customer""",
    "review_dirty": """
SELECT review_id, user_id, business_id,
  CASE WHEN review_id % 33 = 0 THEN CAST(9 AS DOUBLE) ELSE stars END AS stars,
  CASE WHEN review_id % 50 = 0 THEN NULL ELSE useful END AS useful,
  CASE WHEN review_id % 20 = 3 THEN NULL ELSE funny END AS funny,
  CASE WHEN review_id % 37 = 0 THEN -1 ELSE cool END AS cool,
  CASE WHEN review_id % 4 = 0 THEN NULL ELSE text END AS text,
  CASE WHEN review_id % 10 = 0 THEN NULL ELSE date END AS date
FROM review""",
    "review_signal": """
SELECT review_id, user_id, business_id,
  CAST(CASE WHEN CAST(business_id * 7 % 500 AS DOUBLE) / CAST(500 AS DOUBLE) + CAST(user_id * 13 % 97 AS DOUBLE) / CAST(97 AS DOUBLE)
    + CAST(review_id * 7919 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) >= CAST(1.5 AS DOUBLE) THEN 5 ELSE 2 END AS DOUBLE) AS stars,
  useful, funny, cool, text, date
FROM review""",
    "business_dirty": """
SELECT business_id, name, CASE WHEN business_id % 23 = 0 THEN CAST(0.5 AS DOUBLE) ELSE stars END AS stars, is_open,
  CASE WHEN business_id % 13 = 0 THEN CAST(95 AS DOUBLE) ELSE latitude END AS latitude,
  CASE WHEN business_id % 17 = 0 THEN CAST(-200 AS DOUBLE) ELSE longitude END AS longitude,
  CASE WHEN business_id % 19 = 0 THEN CAST(-5 AS BIGINT) ELSE review_count END AS review_count
FROM business""",
    "users_dirty": "SELECT user_id, average_stars, review_count, CASE WHEN user_id % 29 = 0 THEN CAST(-1 AS BIGINT) ELSE fans END AS fans, "
                   "cool, funny, useful, " + ", ".join(
                       f"CAST(CASE WHEN user_id % {31 + i} = 0 THEN -1 ELSE user_id * {i + 1} % 50 END AS BIGINT) AS {c}"
                       for i, c in enumerate(COMPLIMENTS)) + " FROM users",
    "checkin": "SELECT business_id, date FROM review",
    "tip": "SELECT user_id, business_id, text, date, useful AS compliment_count FROM review",
    "scored": """
SELECT review_id, label, score, CASE WHEN score >= CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS prediction
FROM (SELECT review_id, CAST(CASE WHEN stars >= 4 THEN 1 ELSE 0 END AS INTEGER) AS label,
        (CAST(CASE WHEN stars >= 4 THEN 200 ELSE 0 END AS DOUBLE)
         + CAST((review_id * 7919) % 800 AS DOUBLE)) / CAST(1000 AS DOUBLE) AS score FROM review) t""",
}

_DEPENDS = {
    "review": (),
    "business": (),
    "users": (),
    "review_dirty": ("review",),
    "scored": ("review",),
    "review_signal": ("review",),
    "business_dirty": ("business",),
    "users_dirty": ("users",),
    "checkin": ("review",),
    "tip": ("review",),
}


def with_views(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` prefix declaring the named fixture views (and their dependencies)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPENDS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({DUCKDB_VIEWS[n].strip()})" for n in order]
    for n, body in (extra or {}).items():
        parts.append(f"{n} AS ({body.strip()})")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
