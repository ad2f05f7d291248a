"""Feature table (M1-M7): star join + target, class weights, normalisation, grid, buckets.

The reference collects three scalars (class counts and two maxima) and runs the join
four times.  Here the scalars are one aggregate over the joined rows, used as one
scalar subquery (``DataFrame.scalar()``): Spark runs it once inside the same action
and inlines the values, with no join and no collect.  The subquery branch is pruned
to the three columns it reads (no text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.columns import binarise, bucketise, geo_round, safe_div, text_length
from ridgeline.functions.columns import with_stats
from ridgeline.operators.joins import attach_text, enrich, enrich_facts
from ridgeline.sources.io import write_parquet

# Fixed values from the reference feature table.
HIGH_STAR_AT = 4
USER_BUCKET_CUTS = (10, 50)
USER_BUCKET_NAMES = ("low", "medium", "high")
GEO_DIGITS = 2


def add_target(df: DataFrame, c: str = "review_stars", at: float = HIGH_STAR_AT,
               out: str = "is_high_star") -> DataFrame:
    """M1: binary target."""
    return df.withColumn(out, binarise(c, at))


def class_aggs(label: str) -> list[Column]:
    """Aggregates ``n``, ``n_pos``, ``n_neg``: the class counts behind the balanced weights."""
    return [F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg")]


def max_aggs(cols: Sequence[str]) -> list[Column]:
    return [F.max(c).alias(f"max_{i}") for i, c in enumerate(cols)]


def balanced_weight(label: str) -> Column:
    """``n / (2 * count(class))`` from the scalars in ``_s``."""
    per_class = F.when(F.col(label) == 1, F.col("_s.n_pos")).otherwise(F.col("_s.n_neg"))
    return safe_div("_s.n", per_class * 2)


def max_ratios(cols: Sequence[str], prefix: str) -> dict[str, Column]:
    """``x / max(x)`` from the scalars in ``_s``."""
    return {f"{prefix}{c}": safe_div(c, f"_s.max_{i}") for i, c in enumerate(cols)}


def class_weights(df: DataFrame, label: str = "is_high_star", out: str = "class_weight") -> DataFrame:
    """M2: balanced weights ``n / (2 * count(class))`` attached to every row.

    An absent class gives a NULL weight (the reference raises)."""
    return with_stats(df, df.agg(*class_aggs(label))).withColumn(out, balanced_weight(label)).drop("_s")


def normalise_max(df: DataFrame, cols: Sequence[str], prefix: str = "normalized_") -> DataFrame:
    """M3: ``x / max(x)`` over all rows; zero or NULL maximum gives NULL."""
    return with_stats(df, df.agg(*max_aggs(cols))).withColumns(max_ratios(cols, prefix)).drop("_s")


def geo_grid(df: DataFrame, digits: int = GEO_DIGITS, cols: Sequence[str] = ("latitude", "longitude"),
             prefix: str = "rounded_") -> DataFrame:
    """M4: coordinates rounded to a grid of ``digits`` decimals."""
    return df.withColumns({f"{prefix}{c}": geo_round(c, digits) for c in cols})


def add_text_length(df: DataFrame, c: str = "text", out: str = "review_text_length") -> DataFrame:
    """M5: length of the text in characters."""
    return df.withColumn(out, text_length(c))


def add_buckets(df: DataFrame, c: str = "user_review_count", cuts: Sequence[float] = USER_BUCKET_CUTS,
                names: Sequence[str] = USER_BUCKET_NAMES, out: str = "user_review_bucket") -> DataFrame:
    """M6: named buckets of a numeric column (NULL goes to the last bucket)."""
    return df.withColumn(out, bucketise(c, cuts, names))


def feature_columns(df: DataFrame) -> DataFrame:
    """M4-M6: row-local columns (no aggregate)."""
    return add_buckets(add_text_length(geo_grid(df)))


def build_features(reviews: DataFrame, business: DataFrame, users: DataFrame,
                   salts: int | None = None, staging: str | None = None, keep: Sequence[str] | None = None,
                   texts: DataFrame | None = None, scalars: DataFrame | None = None) -> DataFrame:
    """M7: the trusted feature table, 28 columns, or those of them named in ``keep``.

    All five scalars (n, n_pos, n_neg, two maxima) come from one aggregate over the joined
    rows.  With ``staging`` the join is written there once (in the shared folder) and both
    the aggregate, which reads three columns, and the result scan that table, so the fact
    table is shuffled once; without it the plan is lazy and the join runs for each of the
    two.  The aggregate's row is written beside it (``<staging>-scalars``), once for all who read the
    result.  Row-local columns are written, too, and with ``keep`` no others than it needs, so that
    whoever wants the text's length only neither writes nor reads the text.  ``salts`` opts into an explicitly salted star join (see
    :func:`ridgeline.operators.joins.enrich`).

    With ``texts`` the reviews have a ``text_id`` in place of the text (see :func:`ridgeline.operators.joins.enrich`).
    A text that is kept is then attached to the staged rows: it is neither staged nor read by who drops it.
    Of a text that is not kept only the length is joined, measured where the texts are read.

    ``scalars`` is that row of another table (its ``<staging>-scalars``), for some of that table's reviews: they get the
    values they have there."""
    base = add_target(enrich(reviews, business, users, salts, texts))
    joined = feature_columns(base)
    local = [c for c in joined.columns if c not in base.columns]
    counts = ("business_review_count", "user_review_count")
    late = texts is not None and (keep is None or "text" in keep)
    if texts is not None:
        joined = add_buckets(geo_grid(add_target(enrich_facts(reviews, business, users, salts))))
        if not late:
            joined = attach_text(joined, add_text_length(texts).drop("text"))
    if keep is not None:
        joined = joined.select(*[c for c in joined.columns if c in keep or c in ("is_high_star", "text_id", *counts)])
    if staging is not None:
        write_parquet(joined, staging)
        joined = joined.sparkSession.read.schema(joined.schema).parquet(staging)
    if late:
        joined = add_text_length(attach_text(joined, texts))
    stats = joined.agg(*class_aggs("is_high_star"), *max_aggs(counts)) if scalars is None else scalars
    if staging is not None and scalars is None:
        stats.write.mode("overwrite").parquet(f"{staging}-scalars")
        stats = stats.sparkSession.read.schema(stats.schema).parquet(f"{staging}-scalars")
    scaled = {"class_weight": balanced_weight("is_high_star"), **max_ratios(counts, "normalized_")}
    out = [c for c in (*base.columns, *scaled, *local) if keep is None or c in keep]
    return with_stats(joined, stats).withColumns(scaled).select(*out)
