"""Joins (J1-J3): fact-to-dimension inner equi-joins and the star enrichment.

No broadcast hint is given for the dimensions: Catalyst broadcasts a side only when
its size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE converts
a sort-merge join to a broadcast join only when the *measured* shuffle output is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Beyond that the join stays
a sort-merge join, and AQE's skew-join split handles a hot key on the fact side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_inner(left: DataFrame, right: DataFrame, key: str,
               left_alias: str = "l", right_alias: str = "r") -> DataFrame:
    """Inner equi-join on ``key``: unmatched and NULL keys drop, duplicate keys fan out.

    Both key columns are kept, qualified by the aliases."""
    l, r = left.alias(left_alias), right.alias(right_alias)
    return l.join(r, F.col(f"{left_alias}.{key}") == F.col(f"{right_alias}.{key}"), "inner")


# Columns of the feature table as (side.column, output name); d0 is the
# business side, d1 the user side.
STAR_COLUMNS = (
    ("fact.review_id", "review_id"),
    ("fact.stars", "review_stars"),
    ("fact.text", "text"),
    ("fact.date", "date"),
    ("fact.cool", "review_cool"),
    ("fact.funny", "review_funny"),
    ("fact.useful", "review_useful"),
    ("d0.business_id", "business_id"),
    ("d0.stars", "business_stars"),
    ("d0.is_open", "is_open"),
    ("d0.latitude", "latitude"),
    ("d0.longitude", "longitude"),
    ("d0.review_count", "business_review_count"),
    ("d1.user_id", "user_id"),
    ("d1.average_stars", "user_average_stars"),
    ("d1.review_count", "user_review_count"),
    ("d1.fans", "fans"),
    ("d1.cool", "user_cool"),
    ("d1.funny", "user_funny"),
    ("d1.useful", "user_useful"),
)


def salted(fact: DataFrame, dim: DataFrame, salts: int, salt_key: str) -> tuple[DataFrame, DataFrame]:
    """Salt a fact-to-dimension join: each fact row gets ``_salt`` in ``0..salts-1`` from a
    stable hash of ``salt_key`` (a unique row key), each dimension row is replicated once
    per salt.  Joining on ``(key, _salt)`` spreads one hot key over ``salts`` tasks.  The
    dimension grows ``salts`` times, so this suits dimensions much smaller than the fact."""
    f = fact.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_key)), F.lit(salts)).cast("int"))
    d = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return f, d


def star(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str]], salts: int | None = None,
         salt_key: str | None = None) -> DataFrame:
    """Inner equi-joins of ``fact`` with every ``(dimension, key)``, each by :func:`join_inner`'s rule:
    unmatched and NULL keys drop, duplicate keys fan out.  Columns are named ``fact.c`` and ``d<i>.c``.

    ``salts`` spreads a hot key over that many tasks (see :func:`salted`)."""
    wide = fact.select(*[F.col(c).alias(f"fact.{c}") for c in fact.columns])
    for i, (dimension, key) in enumerate(dimensions):
        side = dimension.select(*[F.col(c).alias(f"d{i}.{c}") for c in dimension.columns])
        if salts and salts > 1:
            wide, side = salted(wide, side, salts, f"`fact.{salt_key}`")
            on = (F.col(f"`fact.{key}`") == F.col(f"`d{i}.{key}`")) & (wide["_salt"] == side["_salt"])
            wide = wide.join(side, on).drop("_salt")
        else:
            wide = wide.join(side, F.col(f"`fact.{key}`") == F.col(f"`d{i}.{key}`"))
    return wide


def enrich_facts(reviews: DataFrame, business: DataFrame, users: DataFrame, salts: int | None = None) -> DataFrame:
    """:func:`enrich` of reviews that have a ``text_id`` in place of their text: the projection without
    the text, and the ``text_id``, by which :func:`attach_text` joins it."""
    wide = star(reviews, [(business, "business_id"), (users, "user_id")], salts, "review_id")
    return wide.select(*[F.col(f"`{source}`").alias(name) for source, name in STAR_COLUMNS if name != "text"], F.col("`fact.text_id`").alias("text_id"))


def attach_text(facts: DataFrame, texts: DataFrame) -> DataFrame:
    """Inner join with ``texts`` (``text_id`` and the text, or what is wanted of it); the ``text_id`` goes."""
    return facts.join(texts, "text_id").drop("text_id")


def enrich(reviews: DataFrame, business: DataFrame, users: DataFrame, salts: int | None = None,
           texts: DataFrame | None = None) -> DataFrame:
    """Review x business x user star join with the 20-column disambiguated projection.

    Catalyst prunes every scan to the projected columns and infers ``IsNotNull`` on
    both keys, which reaches the Parquet reader as a pushed filter.  With AQE on (the
    default) a hot business or user is split at run time; ``salts`` opts into explicit
    salting of both joins instead.

    With ``texts`` (``text_id, text``) the reviews have a ``text_id`` in place of the text, which is joined
    last: the other joins then shuffle narrow rows, and every text travels once, not once a review and join."""
    names = [name for _, name in STAR_COLUMNS]
    if texts is not None:
        return attach_text(enrich_facts(reviews, business, users, salts), texts).select(*names)
    wide = star(reviews, [(business, "business_id"), (users, "user_id")], salts, "review_id")
    return wide.select(*[F.col(f"`{source}`").alias(name) for source, name in STAR_COLUMNS])


def bucketed_star(reviews: DataFrame, business: DataFrame, users: DataFrame, folder: str, prefix: str,
                  buckets: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables of :func:`enrich`, with the fact and the users bucketed by ``user_id``.

    They are written under ``folder`` and as catalog tables ``<prefix>_reviews`` and ``<prefix>_users``; the smaller
    business side is left to Catalyst, which broadcasts it while it is under the threshold.  The
    star join then reads the fact bucket by bucket, without an exchange, as often as it is run.  Rows without a user
    join with nothing and are not written."""
    from ridgeline.sources.io import write_bucketed

    base = folder.rstrip("/")
    fact = write_bucketed(reviews.where("user_id IS NOT NULL"), f"{prefix}_reviews", f"{base}/reviews", "user_id", buckets)
    side = write_bucketed(users.where("user_id IS NOT NULL"), f"{prefix}_users", f"{base}/users", "user_id", buckets)
    return fact, business, side


def review_business(reviews: DataFrame, business: DataFrame) -> DataFrame:
    """J1 alone: reviews with their business columns."""
    joined = join_inner(reviews, business, "business_id", "fact", "d0")
    names = ("review_id", "review_stars", "business_id", "business_stars", "business_review_count")
    return joined.select(*[F.col(source).alias(name) for source, name in STAR_COLUMNS if name in names])
