"""Query registry: one Spark plan per operator, with its DuckDB oracle where deterministic.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver's
tables (through the fixture views).  ``ORACLE`` holds equivalent DuckDB SQL over the
same parquet tables; column names are aliased identically on both sides.  Float
aggregates whose summation order differs between engines are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.operators import clean as C
from ridgeline.operators import histogram as H
from ridgeline.operators import metrics as M
from ridgeline.operators import profile as P
from ridgeline.operators import sampling as L
from ridgeline.operators.joins import bucketed_star, enrich, review_business
from ridgeline.session import scratch_path
from ridgeline.plans import features as FE
from ridgeline.sources import fixtures as fx
from ridgeline.sources import io as IO
from ridgeline.sources import zone as Z
from ridgeline.sources.fixtures import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ROUND = 6


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = ROUND) -> DataFrame:
    return df.select(*[
        F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`")
        for c, t in df.dtypes
    ])


def _facts(spark, d):
    """The star with the texts apart, for the joins that attach them last."""
    return fx.review_facts(spark, d), fx.business(spark, d), fx.users(spark, d)


def _enriched(spark, d):
    return enrich(*_facts(spark, d), texts=fx.review_texts(spark, d))


def _features(spark, d, keep=None):
    return FE.build_features(*_facts(spark, d), staging=scratch_path(spark, "star"), keep=keep, texts=fx.review_texts(spark, d))


def _invariants(spark, checks: dict[str, bool]) -> DataFrame:
    return spark.createDataFrame([(k, bool(v)) for k, v in checks.items()], "check string, holds boolean")


def _invariants_sql(*checks: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{c}', true)" for c in checks) + ') t("check", holds)'


# --------------------------------------------------------------------------- SQL pieces
JOINED_SQL = """
SELECT r.review_id, r.stars AS review_stars, r.text, r.date, r.cool AS review_cool,
  r.funny AS review_funny, r.useful AS review_useful, b.business_id, b.stars AS business_stars,
  b.is_open, b.latitude, b.longitude, b.review_count AS business_review_count, u.user_id,
  u.average_stars AS user_average_stars, u.review_count AS user_review_count, u.fans,
  u.cool AS user_cool, u.funny AS user_funny, u.useful AS user_useful
FROM review r JOIN business b ON r.business_id = b.business_id JOIN users u ON r.user_id = u.user_id"""

TARGET_SQL = """
SELECT *, CAST(CASE WHEN review_stars >= 4 THEN 1 ELSE 0 END AS INTEGER) AS is_high_star FROM joined"""

FEATURES_SQL = """
SELECT t.*,
  CASE WHEN t.is_high_star = 1 THEN CAST(s.n AS DOUBLE) / CAST(s.n_pos * 2 AS DOUBLE)
       ELSE CAST(s.n AS DOUBLE) / CAST(s.n_neg * 2 AS DOUBLE) END AS class_weight,
  CAST(t.business_review_count AS DOUBLE) / CAST(s.max_b AS DOUBLE) AS normalized_business_review_count,
  CAST(t.user_review_count AS DOUBLE) / CAST(s.max_u AS DOUBLE) AS normalized_user_review_count,
  round(t.latitude, 2) AS rounded_latitude, round(t.longitude, 2) AS rounded_longitude,
  CAST(length(t.text) AS INTEGER) AS review_text_length,
  CASE WHEN t.user_review_count < 10 THEN 'low' WHEN t.user_review_count < 50 THEN 'medium'
       ELSE 'high' END AS user_review_bucket
FROM targeted t, (SELECT count(*) AS n, count_if(is_high_star = 1) AS n_pos,
  count_if(is_high_star = 0) AS n_neg, max(business_review_count) AS max_b,
  max(user_review_count) AS max_u FROM targeted) s"""


def _features_with(**extra) -> str:
    return with_views("review", "business", "users", extra={
        "joined": JOINED_SQL, "targeted": TARGET_SQL, "features": FEATURES_SQL, **extra})


def _joined_with(**extra) -> str:
    return with_views("review", "business", "users", extra={"joined": JOINED_SQL, **extra})


# --------------------------------------------------------------------------- features
@query("trusted_features", _features_with() + "SELECT * FROM features")
def q_trusted_features(spark, d):
    return _features(spark, d)


@query("star_enrich", _joined_with() + "SELECT * FROM joined")
def q_star_enrich(spark, d):
    return _enriched(spark, d)


@query("star_enrich_bucketed", ORACLE["star_enrich"])
def q_star_enrich_bucketed(spark, d):
    """The star join over a fact table and users that are stored in buckets of the join key."""
    folder = scratch_path(spark, "star")
    stored = bucketed_star(*_facts(spark, d), folder, folder.rsplit("/", 1)[-1].replace("-", "_"), buckets=16)
    return enrich(*stored, texts=fx.review_texts(spark, d))


@query("review_business", with_views("review", "business") + """
SELECT r.review_id, r.stars AS review_stars, b.business_id, b.stars AS business_stars,
  b.review_count AS business_review_count
FROM review r JOIN business b ON r.business_id = b.business_id""")
def q_review_business(spark, d):
    return review_business(fx.review(spark, d), fx.business(spark, d))


@query("is_high_star", _joined_with(targeted=TARGET_SQL)
       + "SELECT review_id, review_stars, is_high_star FROM targeted")
def q_is_high_star(spark, d):
    return FE.add_target(_enriched(spark, d)).select("review_id", "review_stars", "is_high_star")


@query("class_counts", _joined_with(targeted=TARGET_SQL)
       + "SELECT is_high_star, count(*) AS count FROM targeted GROUP BY is_high_star")
def q_class_counts(spark, d):
    return P.class_counts(FE.add_target(_enriched(spark, d)), "is_high_star")


@query("class_weights", _features_with() + "SELECT review_id, is_high_star, class_weight FROM features")
def q_class_weights(spark, d):
    t = FE.add_target(_enriched(spark, d))
    return FE.class_weights(t).select("review_id", "is_high_star", "class_weight")


@query("normalised_counts", _features_with()
       + "SELECT review_id, normalized_business_review_count, normalized_user_review_count FROM features")
def q_normalised_counts(spark, d):
    j = _enriched(spark, d)
    out = FE.normalise_max(j, ["business_review_count", "user_review_count"])
    return out.select("review_id", "normalized_business_review_count", "normalized_user_review_count")


@query("rounded_geo", _features_with() + "SELECT review_id, rounded_latitude, rounded_longitude FROM features")
def q_rounded_geo(spark, d):
    return FE.feature_columns(_enriched(spark, d)).select("review_id", "rounded_latitude", "rounded_longitude")


@query("text_length", _features_with() + "SELECT review_id, review_text_length FROM features")
def q_text_length(spark, d):
    return FE.feature_columns(_enriched(spark, d)).select("review_id", "review_text_length")


@query("user_review_bucket", _features_with()
       + "SELECT review_id, user_review_count, user_review_bucket FROM features")
def q_user_review_bucket(spark, d):
    return FE.feature_columns(_enriched(spark, d)).select("review_id", "user_review_count", "user_review_bucket")


# --------------------------------------------------------------------------- cleaning
DIRTY_COLS = ("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "text", "date")
DIRTY_DOUBLES = ("stars",)


def _valid_sql(cols) -> dict[str, str]:
    """Validity SQL per column present (mirrors operators.clean rules)."""
    out = {}
    for c, lo, hi in C.RANGE_RULES:
        if c in cols:
            out[c] = f"({c} >= {lo} AND {c} <= {hi})"
    for c in C.NON_NEGATIVE_COLUMNS:
        if c in cols:
            out[c] = f"({c} >= 0)"
    return out


def clean_stats_sql(view: str, cols, doubles, policy: str) -> str:
    """Dynamic SQL for a cleaning policy's summary: which columns drop is computed from
    the data (null fraction), and the kept-row predicate skips dropped columns."""
    spec = C.POLICIES[policy]
    frac = spec["max_null_frac"]
    flags = []
    for c in cols:
        if frac is None:
            flags.append(f"false AS d_{c}")
        else:
            flags.append(f"coalesce(CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) > {frac}, false) AS d_{c}")
    valid = _valid_sql(cols) if spec["validate"] else {}
    keep = []
    for c in cols:
        nn = f"{c} IS NOT NULL" + (f" AND NOT isnan({c})" if c in doubles else "")
        keep.append(f"(st.d_{c} OR ({nn}))")
        if c in valid:
            keep.append(f"(st.d_{c} OR {valid[c]})")
    dropped = ", ".join(f"CASE WHEN st.d_{c} THEN '{c}' END" for c in sorted(cols))
    n_dropped = " + ".join(f"CAST(st.d_{c} AS INTEGER)" for c in cols)
    flags_from = f" FROM {view}" if frac is not None else ""
    return f"""
SELECT '{policy}' AS policy, CAST(count(*) AS BIGINT) AS rows_before,
  CAST(count_if({' AND '.join(keep)}) AS BIGINT) AS rows_after,
  CAST(count(*) - count_if({' AND '.join(keep)}) AS BIGINT) AS rows_dropped,
  CAST({len(cols)} AS INTEGER) AS columns_before,
  CAST({len(cols)} - ({n_dropped}) AS INTEGER) AS columns_after,
  CAST({n_dropped} AS INTEGER) AS columns_dropped,
  concat_ws(',', {dropped}) AS dropped_columns
FROM {view}, (SELECT {', '.join(flags)}{flags_from}) st
GROUP BY ALL"""


def _dirty(spark, d):
    return fx.review_dirty(spark, d)


def _staged_dirty(spark, d):
    """``review_dirty`` written once and read back, for those who read it several times: its join runs once."""
    path = scratch_path(spark, "dirty")
    IO.write_parquet(_dirty(spark, d), path)
    return IO.read_table(spark, path)


NOT_NULL_ALL = " AND ".join(f"{c} IS NOT NULL" for c in DIRTY_COLS) + " AND NOT isnan(stars)"


@query("drop_columns", with_views("review_dirty")
       + "SELECT review_id, user_id, business_id, stars, useful, funny, cool, date FROM review_dirty")
def q_drop_columns(spark, d):
    return C.drop_columns(_dirty(spark, d), ["text"])


@query("normalise_names", with_views("business") + "SELECT * FROM business")
def q_normalise_names(spark, d):
    b = fx.business(spark, d)
    spaced = b.toDF(*[c.replace("_", " ") for c in b.columns])
    return C.normalise_names(spaced)


@query("select_numeric", with_views("review_dirty")
       + "SELECT review_id, user_id, business_id, stars, useful, funny, cool FROM review_dirty")
def q_select_numeric(spark, d):
    df = _dirty(spark, d)
    return df.select(*C.numeric_columns(df))


# SQL cannot drop columns by a data-dependent rule, so these oracles list the columns
# the policy keeps on review_dirty (sparse20 drops text; validated drops text and date;
# rename drops none).  Which columns drop is itself checked from the data by
# clean_summary's oracle.
@query("clean_20", with_views("review_dirty") + f"""
SELECT review_id, user_id, business_id, stars, useful, funny, cool, date FROM review_dirty
WHERE review_id IS NOT NULL AND user_id IS NOT NULL AND business_id IS NOT NULL AND stars IS NOT NULL
  AND NOT isnan(stars) AND useful IS NOT NULL AND funny IS NOT NULL AND cool IS NOT NULL AND date IS NOT NULL""")
def q_clean_20(spark, d):
    return C.clean(_dirty(spark, d), "sparse20")


@query("clean_05", with_views("review_dirty") + """
SELECT review_id, user_id, business_id, stars, useful, funny, cool FROM review_dirty
WHERE stars >= 1 AND stars <= 5 AND cool >= 0 AND funny >= 0 AND useful >= 0
  AND review_id IS NOT NULL AND user_id IS NOT NULL AND business_id IS NOT NULL AND NOT isnan(stars)""")
def q_clean_05(spark, d):
    return C.clean(_dirty(spark, d), "validated")


@query("clean_rename", with_views("review_dirty") + f"SELECT * FROM review_dirty WHERE {NOT_NULL_ALL}")
def q_clean_rename(spark, d):
    return C.clean(_dirty(spark, d), "rename")


@query("validity_filter", with_views("review_dirty") + """
SELECT * FROM review_dirty
WHERE stars >= 1 AND stars <= 5 AND cool >= 0 AND funny >= 0 AND useful >= 0""")
def q_validity_filter(spark, d):
    return C.validity_filter(_dirty(spark, d))


@query("dropna_any", with_views("review_dirty") + f"SELECT * FROM review_dirty WHERE {NOT_NULL_ALL}")
def q_dropna_any(spark, d):
    return C.drop_null_rows(_dirty(spark, d))


@query("clean_summary", with_views("review_dirty") + "\nUNION ALL\n".join(
    clean_stats_sql("review_dirty", DIRTY_COLS, DIRTY_DOUBLES, p) for p in ("sparse20", "validated", "rename")))
def q_clean_summary(spark, d):
    return C.clean_summaries(_dirty(spark, d), ("sparse20", "validated", "rename"))


# --------------------------------------------------------------------------- profiling
_COUNTED = ("review", "business", "users", "review_dirty")
_COUNTED_BASE = ("events", "documents", "supplier", "customer")


@query("table_row_counts", with_views(*_COUNTED) + "\nUNION ALL\n".join(
    [f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in _COUNTED + _COUNTED_BASE]))
def q_table_row_counts(spark, d):
    frames = [P.row_count(fx.VIEWS[t](spark, d), t) for t in _COUNTED]
    frames += [P.row_count(df, t) for t, df in IO.load_tables(spark, d, _COUNTED_BASE).items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("null_counts", with_views("review_dirty") + "SELECT " + ", ".join(
    f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in DIRTY_COLS) + " FROM review_dirty")
def q_null_counts(spark, d):
    return P.null_counts(_dirty(spark, d))


@query("null_audit", with_views("review_dirty") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
    f"round(CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE), {ROUND}) AS null_frac FROM review_dirty"
    for c in DIRTY_COLS))
def q_null_audit(spark, d):
    return round_doubles(P.null_audit(_dirty(spark, d)))


_NUM = ("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool")


@query("numeric_stats", with_views("review_dirty") + "SELECT " + ", ".join(
    [f"min({c}) AS {c}_min" for c in _NUM] + [f"max({c}) AS {c}_max" for c in _NUM]
    + [f"round(avg({c}), {ROUND}) AS {c}_mean" for c in _NUM]
    + [f"round(stddev_samp({c}), {ROUND}) AS {c}_stddev" for c in _NUM]) + " FROM review_dirty")
def q_numeric_stats(spark, d):
    return round_doubles(P.numeric_stats(_dirty(spark, d)))


@query("date_range", with_views("review_dirty")
       + "SELECT min(date) AS min_date, max(date) AS max_date FROM review_dirty")
def q_date_range(spark, d):
    return P.date_range(_dirty(spark, d))


@query("text_length_stats", with_views("review_dirty") + f"""
SELECT CAST(min(length(text)) AS INTEGER) AS min_length, CAST(max(length(text)) AS INTEGER) AS max_length,
  round(avg(length(text)), {ROUND}) AS mean_length, round(stddev_samp(length(text)), {ROUND}) AS stddev_length
FROM review_dirty""")
def q_text_length_stats(spark, d):
    return round_doubles(P.text_length_stats(_dirty(spark, d)))


def _describe_sql(view: str, cols, numeric) -> str:
    parts = []
    for c in cols:
        number, none = c in numeric, "max(CAST(NULL AS DOUBLE))"
        for m, fn in (("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max")):
            value = f"round(CAST({fn}({c}) AS DOUBLE), {ROUND})" if number or m == "count" else none
            as_text = f"{fn}({c})" if not number and m in ("min", "max") else "CAST(NULL AS VARCHAR)"
            parts.append(f"SELECT '{c}' AS \"column\", '{m}' AS metric, {value} AS value, {as_text} AS text FROM {view}")
    return "\nUNION ALL\n".join(parts)


@query("describe", with_views("review_dirty") + _describe_sql(
    "review_dirty", DIRTY_COLS, ("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool")))
def q_describe(spark, d):
    """``describe()`` with its strings typed: numbers in ``value``, other values in ``text``."""
    number = F.expr("try_cast(value AS DOUBLE)")
    return round_doubles(P.describe_long(_dirty(spark, d)).select(
        "column", "metric", number.alias("value"), F.when(number.isNull(), F.col("value")).alias("text")))


@query("describe_numeric", with_views("review_dirty") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), {ROUND}) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), {ROUND}) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM review_dirty" for c in _NUM))
def q_describe_numeric(spark, d):
    return round_doubles(P.describe_numeric(_dirty(spark, d)))


@query("distinct_counts", with_views("review_dirty") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
    f" AS n_distinct FROM review_dirty" for c in DIRTY_COLS))
def q_distinct_counts(spark, d):
    return P.distinct_counts(_dirty(spark, d))


@query("approx_distinct", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', true)" for c in DIRTY_COLS) + ") t(\"column\", within)")
def q_approx_distinct(spark, d):
    """Sketch counts against exact ones: within five relative standard deviations (and 1)."""
    dirty, rsd = _dirty(spark, d), 0.05
    about = P.distinct_counts(dirty, approx=True, rsd=rsd).withColumnRenamed("n_distinct", "about")
    near = F.abs(F.col("about") - F.col("n_distinct")) <= 5 * rsd * F.col("n_distinct") + 1
    return P.distinct_counts(dirty).join(about, "column").select("column", near.alias("within"))


_CORR_COLS = ("review_stars", "business_stars", "latitude", "longitude", "user_average_stars",
              "is_high_star", "class_weight", "normalized_business_review_count",
              "normalized_user_review_count", "rounded_latitude", "rounded_longitude", "review_text_length")


@query("distinct_sketches", with_views("review_dirty") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_nulls, true AS as_whole, true AS within FROM review_dirty" for c in DIRTY_COLS))
def q_distinct_sketches(spark, d):
    """Sketches stored per part of the table and united on reading: estimates as of the whole's, near the exact counts."""
    dirty = _staged_dirty(spark, d)
    path = scratch_path(spark, "sketches")
    for k in range(3):
        IO.write_parquet(P.distinct_sketches(dirty.where(F.col("review_id") % 3 == k)), f"{path}/part={k}")
    parts = P.sketch_counts(IO.read_table(spark, path))
    whole = P.sketch_counts(P.distinct_sketches(dirty)).select("column", F.col("n_distinct").alias("whole"))
    exact = P.distinct_counts(dirty).select("column", F.col("n_distinct").alias("exact"))
    deviation = 1.04 / 2 ** (P.SKETCH_LG / 2)
    return parts.join(whole, "column").join(exact, "column").select(
        "column", "n_rows", "n_nulls", (F.col("n_distinct") == F.col("whole")).alias("as_whole"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 5 * deviation * F.col("exact")).alias("within"))


def _correlation_sql() -> str:
    cols = _CORR_COLS
    complete = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    aggs = [f"stddev_pop(CAST({c} AS DOUBLE)) AS sd{i}" for i, c in enumerate(cols)]
    parts = []
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            aggs.append(f"covar_pop(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE)) AS cv{i}_{j}")
            r = f"round(CASE WHEN sd{i} * sd{j} = 0 THEN NULL ELSE cv{i}_{j} / (sd{i} * sd{j}) END, {ROUND})"
            parts.append(f"SELECT '{cols[i]}' AS x, '{cols[j]}' AS y, {r} AS corr FROM agg")
            if i != j:
                parts.append(f"SELECT '{cols[j]}' AS x, '{cols[i]}' AS y, {r} AS corr FROM agg")
    return _features_with(agg=f"SELECT {', '.join(aggs)} FROM features WHERE {complete}") + "\nUNION ALL\n".join(parts)


@query("correlation", _correlation_sql())
def q_correlation(spark, d):
    return round_doubles(P.correlation_long(_features(spark, d, keep=_CORR_COLS)))


def _offset_sql() -> str:
    cols = ("x", "y", "z")
    views = {"far": "SELECT 1.7e9 + event_id % 10 AS x, 1.7e9 - event_id % 10 AS y, CAST(event_id % 10 AS DOUBLE) AS z FROM events"}
    return with_views(extra=views) + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})), {ROUND}) AS corr FROM far"
        for a in cols for b in cols)


@query("correlation_offset", _offset_sql())
def q_correlation_offset(spark, d):
    """Columns whose mean dwarfs their spread (Unix times, ids)."""
    k = F.col("event_id") % 10
    far = fx.base(spark, d, "events").select((F.lit(1.7e9) + k).alias("x"), (F.lit(1.7e9) - k).alias("y"), k.cast("double").alias("z"))
    return round_doubles(P.correlation_long(far))


@query("schema_table", with_views("review_dirty") + """
SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS pos, column_name AS "column",
  CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
    WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS type
FROM (DESCRIBE SELECT * FROM review_dirty)""")
def q_schema_table(spark, d):
    from ridgeline.sources.io import schema_table
    return schema_table(_dirty(spark, d))


@query("preview_rows", _features_with() + "SELECT * FROM features ORDER BY review_id LIMIT 5")
def q_preview_rows(spark, d):
    from ridgeline.sources.io import preview
    return preview(_features(spark, d), 5, "review_id")


@query("top_reviews", with_views("review")
       + "SELECT review_id, stars FROM review ORDER BY review_id LIMIT 20")
def q_top_reviews(spark, d):
    return L.limit_rows(fx.review(spark, d).select("review_id", "stars"), 20, "review_id")


@query("limit_rows", with_views("review_dirty")
       + "SELECT useful FROM review_dirty WHERE useful IS NOT NULL ORDER BY useful LIMIT 10")
def q_limit_rows(spark, d):
    return L.first_values(_dirty(spark, d), "useful", 10)


_TYPES = {"is_open": "bigint", "name": "string", "text": "string", "date": "string", "stars": "double",
          "average_stars": "double", "latitude": "double", "longitude": "double", "is_high_star": "int",
          "review_text_length": "int", "user_review_bucket": "string"}


def _profile_sql(view: str, cols, numeric) -> list[str]:
    parts, none = [], "CAST(NULL AS VARCHAR)"
    for c in cols:
        parts.append(f"SELECT '{view}' AS \"table\", '{c}' AS \"column\", 'nulls' AS metric, "
                     f"CAST(count(*) - count({c}) AS DOUBLE) AS value, {none} AS text FROM {view}")
        parts.append(f"SELECT '{view}', '{c}', 'count', CAST(count({c}) AS DOUBLE), {none} FROM {view}")
        parts.append(f"SELECT '{view}', '{c}', 'type', CAST(NULL AS DOUBLE), '{_TYPES.get(c, 'bigint')}'")
        parts.append(f"SELECT '{view}', '{c}', 'distinct', CAST(count(DISTINCT {c}) + "
                     f"coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS DOUBLE), {none} FROM {view}")
        if c in numeric:
            for m, fn in (("min", "min"), ("max", "max"), ("mean", "avg"), ("stddev", "stddev_samp")):
                parts.append(f"SELECT '{view}', '{c}', '{m}', round({fn}(CAST({c} AS DOUBLE)), {ROUND}), {none} FROM {view}")
        else:
            parts += [f"SELECT '{view}', '{c}', '{m}', CAST(NULL AS DOUBLE), {m}({c}) FROM {view}" for m in ("min", "max")]
    return parts


_PROFILE_TABLES = {
    "review": (("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool", "text", "date"),
               ("review_id", "user_id", "business_id", "stars", "useful", "funny", "cool")),
    "business": (("business_id", "name", "stars", "is_open", "latitude", "longitude", "review_count"),
                 ("business_id", "stars", "is_open", "latitude", "longitude", "review_count")),
    "users": (("user_id", "average_stars", "review_count", "fans", "cool", "funny", "useful"),
              ("user_id", "average_stars", "review_count", "fans", "cool", "funny", "useful")),
}


@query("profile_long", with_views(*_PROFILE_TABLES) + "\nUNION ALL\n".join(
    p for t, (cols, num) in _PROFILE_TABLES.items() for p in _profile_sql(t, cols, num)))
def q_profile_long(spark, d):
    frames = [P.profile_long(fx.VIEWS[t](spark, d), t) for t in _PROFILE_TABLES]
    out = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return round_doubles(out)


_CORR_OF_TABLE = {"review": ("stars",), "business": ("stars", "latitude", "longitude"), "users": ("average_stars",)}


def _metadata_sql() -> str:
    parts = [p for t, (cols, num) in _PROFILE_TABLES.items() for p in _profile_sql(t, cols, num)]
    for t, cols in _CORR_OF_TABLE.items():
        complete = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        for a in cols:
            for b in cols:
                r = (f"CASE WHEN stddev_pop({a}) * stddev_pop({b}) > 0 THEN "
                     f"least(greatest(covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})), -1.0), 1.0) END")
                parts.append(f"SELECT '{t}', '{a}', 'corr:{b}', round({r}, {ROUND}), CAST(NULL AS VARCHAR) FROM {t} WHERE {complete}")
    return with_views(*_PROFILE_TABLES) + "\nUNION ALL\n".join(parts)


@query("metadata_document", _metadata_sql())
def q_metadata_document(spark, d):
    from ridgeline.plans.metadata import metadata_table
    return round_doubles(metadata_table({t: fx.VIEWS[t](spark, d) for t in _PROFILE_TABLES}))


@query("metadata_roundtrip", _metadata_sql())
def q_metadata_roundtrip(spark, d):
    """The metadata document written as JSON lines and read back."""
    from ridgeline.plans.metadata import write_metadata
    path = scratch_path(spark, "metadata")
    write_metadata({t: fx.VIEWS[t](spark, d) for t in _PROFILE_TABLES}, path)
    schema = "`table` string, `column` string, metric string, value double, text string"
    return round_doubles(IO.read_json(spark, f"{path}/metrics", schema))


# --------------------------------------------------------------------------- distributions
def _hist_sql(values_sql: str, bins: str | int, by: str | None = None) -> str:
    """DuckDB twin of operators.histogram.histogram."""
    if bins == "auto":
        width = "least(greatest(fd, half_sqrt), sturges)"
        k = (f"CASE WHEN n = 0 THEN 0 WHEN {width} > 0 "
             f"THEN CAST(ceil((hi - lo) / {width}) AS INTEGER) ELSE 1 END")
        st = ("SELECT n, lo, hi, (hi - lo) / (log2(CAST(n AS DOUBLE)) + 1.0) AS sturges, "
              "(hi - lo) / sqrt(CAST(n AS DOUBLE)) / 2.0 AS half_sqrt, "
              "2.0 * (q75 - q25) * pow(CAST(n AS DOUBLE), -1.0 / 3.0) AS fd FROM (SELECT count(*) AS n, "
              "min(x) AS lo, max(x) AS hi, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.75) AS q75 FROM v) t")
    else:
        k = f"CASE WHEN n = 0 THEN 0 ELSE {int(bins)} END"
        st = "SELECT count(*) AS n, min(x) AS lo, max(x) AS hi FROM v"
    g = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM v) gr, " if by else ""
    return f"""
WITH v AS ({values_sql}),
st AS ({st}),
e AS (SELECT CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS first,
             CASE WHEN hi = lo THEN hi + 0.5 ELSE hi END AS last, {k} AS k FROM st),
c AS (SELECT {g}CAST(least(floor((x - first) / (last - first) * k), k - 1) AS INTEGER) AS bin, count(*) AS n
      FROM v, e GROUP BY ALL),
grid AS (SELECT {g}CAST(i AS INTEGER) AS bin, first + i * ((last - first) / k) AS lo,
                CASE WHEN i = k - 1 THEN last ELSE first + (i + 1) * ((last - first) / k) END AS hi
         FROM {groups}e, (SELECT unnest(range(0, (SELECT k FROM e))) AS i) ii)
SELECT {g}grid.bin, round(grid.lo, {ROUND}) AS lo, round(grid.hi, {ROUND}) AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid LEFT JOIN c USING ({g}bin)"""


@query("histogram_auto", _hist_sql(
    "SELECT CAST(value AS DOUBLE) AS x FROM events WHERE value IS NOT NULL AND NOT isnan(value)", "auto"))
def q_histogram_auto(spark, d):
    return round_doubles(H.histogram(fx.base(spark, d, "events"), "value", "auto"))


def _numeric_histograms_sql() -> str:
    parts = []
    for c in _NUM:
        body = _hist_sql(f"SELECT CAST({c} AS DOUBLE) AS x FROM review_dirty WHERE {c} IS NOT NULL "
                         f"AND NOT isnan(CAST({c} AS DOUBLE))", "auto")
        parts.append(f"SELECT '{c}' AS \"column\", * FROM ({body}) h{len(parts)}")
    return with_views("review_dirty") + "\nUNION ALL\n".join(parts)


@query("histograms_numeric", _numeric_histograms_sql())
def q_histograms_numeric(spark, d):
    return round_doubles(H.numeric_histograms(_dirty(spark, d)))


_TEXT_LEN_VALUES = ("SELECT CAST(length(text) AS DOUBLE) AS x FROM review WHERE text IS NOT NULL")


@query("histogram_30", with_views("review").rstrip() + ",\n"
       + _hist_sql(_TEXT_LEN_VALUES, 30).strip()[len("WITH "):])
def q_histogram_30(spark, d):
    r = fx.review(spark, d).select(F.length("text").alias("text_length"))
    return round_doubles(H.histogram(r, "text_length", 30))


@query("histogram_by_label", with_views("scored").rstrip() + ",\n" + _hist_sql(
    "SELECT CAST(score AS DOUBLE) AS x, label FROM scored WHERE score IS NOT NULL AND NOT isnan(score)",
    20, by="label").strip()[len("WITH "):])
def q_histogram_by_label(spark, d):
    return round_doubles(H.histogram(fx.scored(spark, d), "score", 20, by="label"))


def _null_safe(sql: str) -> str:
    return sql.replace("USING (label, bin)", "ON grid.bin = c.bin AND grid.label IS NOT DISTINCT FROM c.label").replace(
        "SELECT label, grid.bin,", "SELECT grid.label, grid.bin,")


_NULL_LABEL = "SELECT nullif(label, 0) AS label, CAST(score AS DOUBLE) AS x FROM scored WHERE score IS NOT NULL AND NOT isnan(score)"


@query("histogram_null_group", with_views("scored").rstrip() + ",\n"
       + _null_safe(_hist_sql(_NULL_LABEL, 20, by="label").strip()[len("WITH "):]))
def q_histogram_null_group(spark, d):
    """A NULL group is a group."""
    rows = fx.scored(spark, d).withColumn("label", F.nullif(F.col("label"), F.lit(0)))
    return round_doubles(H.histogram(rows, "score", 20, by="label"))


DENSITY_DIGITS = 12


def _density_sql(values_sql: str, points: int = H.DEFAULT_POINTS) -> str:
    return f"""
v AS ({values_sql}),
cnt AS (SELECT x, count(*) AS w FROM v GROUP BY x),
st AS (SELECT count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h,
              min(x) AS lo, max(x) AS hi FROM v),
g AS (SELECT n, h, lo - 0.0 * h AS g0, (hi - lo + 0.0 * h) / {points - 1}.0 AS step FROM st),
pts AS (SELECT CAST(i AS INTEGER) AS point, g0 + i * step AS gx, n, h, step
        FROM g, (SELECT unnest(range(0, {points})) AS i) ii WHERE n > 0),
d AS (SELECT point, sum(w * exp(-0.5 * ((gx - x) / h) * ((gx - x) / h))) AS k
      FROM pts, cnt WHERE h > 0 AND step > 0 GROUP BY point)
SELECT point, round(gx, {ROUND}) AS x,
  round(CASE WHEN h > 0 AND step > 0 THEN coalesce(k / (n * h * sqrt(2 * pi())), 0.0) END, {DENSITY_DIGITS}) AS density
FROM pts LEFT JOIN d USING (point)"""


@query("density_curve", with_views("review").rstrip() + ",\n" + _density_sql(_TEXT_LEN_VALUES))
def q_density_curve(spark, d):
    r = fx.review(spark, d).select(F.length("text").alias("text_length"))
    out = H.density(r, "text_length")
    return out.select("point", F.round("x", ROUND).alias("x"), F.round("density", DENSITY_DIGITS).alias("density"))


def _density_by_sql(values_sql: str, by: str, points: int = H.DEFAULT_POINTS) -> str:
    return f"""
v AS ({values_sql}),
cnt AS (SELECT {by}, x, count(*) AS w FROM v GROUP BY ALL),
per AS (SELECT {by}, count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM v GROUP BY ALL),
g AS (SELECT min(x) - 0.0 * (SELECT max(h) FROM per) AS g0,
             (max(x) - min(x) + 0.0 * (SELECT max(h) FROM per)) / {points - 1}.0 AS step FROM v),
pts AS (SELECT per.{by}, CAST(i AS INTEGER) AS point, g0 + i * step AS gx, n, h, step
        FROM per, g, (SELECT unnest(range(0, {points})) AS i) ii WHERE n > 0),
d AS (SELECT pts.{by}, point, sum(w * exp(-0.5 * ((gx - x) / pts.h) * ((gx - x) / pts.h))) AS k
      FROM pts JOIN cnt ON pts.{by} = cnt.{by} WHERE pts.h > 0 AND step > 0 GROUP BY ALL)
SELECT pts.{by}, point, round(gx, {ROUND}) AS x,
  round(CASE WHEN h > 0 AND step > 0 THEN coalesce(k / (n * h * sqrt(2 * pi())), 0.0) END, {DENSITY_DIGITS}) AS density
FROM pts LEFT JOIN d USING ({by}, point)"""


@query("density_by_label", with_views("scored").rstrip() + ",\n" + _density_by_sql(
    "SELECT label, CAST(score AS DOUBLE) AS x FROM scored WHERE score IS NOT NULL AND NOT isnan(score)", "label"))
def q_density_by_label(spark, d):
    out = H.density(fx.scored(spark, d), "score", by="label")
    return out.select("label", "point", F.round("x", ROUND).alias("x"),
                      F.round("density", DENSITY_DIGITS).alias("density"))


@query("density_null_group", with_views("scored").rstrip() + ",\n" + _density_by_sql(_NULL_LABEL, "label")
       .replace("ON pts.label = cnt.label", "ON pts.label IS NOT DISTINCT FROM cnt.label")
       .replace("USING (label, point)", "ON pts.point = d.point AND pts.label IS NOT DISTINCT FROM d.label")
       .replace("SELECT pts.label, point, round", "SELECT pts.label, pts.point, round"))
def q_density_null_group(spark, d):
    rows = fx.scored(spark, d).withColumn("label", F.nullif(F.col("label"), F.lit(0)))
    out = H.density(rows, "score", by="label")
    return out.select("label", "point", F.round("x", ROUND).alias("x"), F.round("density", DENSITY_DIGITS).alias("density"))


# --------------------------------------------------------------------------- metrics
def _scored(spark, d):
    return fx.scored(spark, d)


CONFUSION_SQL = """SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
  CAST(count_if(label = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count_if(label = 0 AND prediction = 0) AS BIGINT) AS tn,
  CAST(count_if(label = 1 AND prediction = 0) AS BIGINT) AS fn FROM scored"""

PRF_SQL = f"""SELECT round(coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END, 0.0), {ROUND}) AS precision,
  round(coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END, 0.0), {ROUND}) AS recall,
  round(coalesce(CASE WHEN p + r = 0 THEN NULL ELSE 2.0 * p * r / (p + r) END, 0.0), {ROUND}) AS f1
FROM (SELECT *, coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END, 0.0) AS p,
             coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END, 0.0) AS r
      FROM ({CONFUSION_SQL}) c) t"""

AUC_SQL = """SELECT CASE WHEN p = 0 OR n = 0 THEN NULL ELSE CAST(num AS DOUBLE) / (2.0 * CAST(p AS DOUBLE) * CAST(n AS DOUBLE)) END AS auc
FROM (SELECT sum(CAST(neg AS HUGEINT) * (2 * (cum_pos - pos) + pos)) AS num, sum(pos) AS p, sum(neg) AS n
      FROM (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos
            FROM (SELECT CAST(score AS DOUBLE) AS s, count_if(label = 1) AS pos, count_if(label = 0) AS neg
                  FROM scored WHERE score IS NOT NULL AND NOT isnan(score) AND label IS NOT NULL GROUP BY 1) g) w) a"""


@query("auc_ml_scored", with_views("scored") + f"SELECT round(auc, {ROUND}) AS auc FROM ({AUC_SQL}) a")
def q_auc_ml_scored(spark, d):
    """Spark ML's evaluator on the fixed scores (at most 1,000 distinct, so unbinned)."""
    from ridgeline.plans.model import evaluator
    auc = evaluator().setRawPredictionCol("score").evaluate(_scored(spark, d))
    return spark.createDataFrame([(round(auc, ROUND),)], "auc double")


@query("confusion_counts", with_views("scored") + CONFUSION_SQL)
def q_confusion_counts(spark, d):
    return M.confusion_counts(_scored(spark, d))


@query("precision_recall_f1", with_views("scored") + PRF_SQL)
def q_precision_recall_f1(spark, d):
    return round_doubles(M.precision_recall_f1(_scored(spark, d)))


@query("auc_exact", with_views("scored") + AUC_SQL)
def q_auc_exact(spark, d):
    return M.auc_exact(_scored(spark, d))


@query("roc_curve", with_views("scored") + f"""
SELECT NULL::DOUBLE AS threshold, CASE WHEN n > 0 THEN 0.0 END AS fpr, CASE WHEN p > 0 THEN 0.0 END AS tpr
FROM (SELECT count_if(label = 1) AS p, count_if(label = 0) AS n FROM scored
      WHERE score IS NOT NULL AND NOT isnan(score) AND label IS NOT NULL) t WHERE p + n > 0
UNION ALL
SELECT s AS threshold,
  round(CASE WHEN n = 0 THEN NULL ELSE CAST(cum_neg AS DOUBLE) / CAST(n AS DOUBLE) END, {ROUND}) AS fpr,
  round(CASE WHEN p = 0 THEN NULL ELSE CAST(cum_pos AS DOUBLE) / CAST(p AS DOUBLE) END, {ROUND}) AS tpr
FROM (SELECT s, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER () AS p, sum(neg) OVER () AS n
      FROM (SELECT CAST(score AS DOUBLE) AS s, count_if(label = 1) AS pos, count_if(label = 0) AS neg
            FROM scored WHERE score IS NOT NULL AND NOT isnan(score) AND label IS NOT NULL GROUP BY 1) g
      WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) t""")
def q_roc_curve(spark, d):
    return round_doubles(M.roc_points(_scored(spark, d)))


@query("roc_curve_turns", with_views("scored") + f"""
, c AS (SELECT CAST(score AS DOUBLE) AS s, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM scored
        WHERE score IS NOT NULL AND NOT isnan(score) AND label IS NOT NULL GROUP BY 1),
w AS (SELECT *, sum(pos) OVER o AS cp, sum(neg) OVER o AS cn, lead(pos) OVER (ORDER BY s DESC) AS np, lead(neg) OVER (ORDER BY s DESC) AS nn,
        row_number() OVER (ORDER BY s DESC) AS i FROM c WINDOW o AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM c)
SELECT NULL::DOUBLE AS threshold, CASE WHEN n > 0 THEN 0.0 END AS fpr, CASE WHEN p > 0 THEN 0.0 END AS tpr FROM t WHERE p + n > 0
UNION ALL
SELECT s, round(CASE WHEN n = 0 THEN NULL ELSE CAST(cn AS DOUBLE) / CAST(n AS DOUBLE) END, {ROUND}),
  round(CASE WHEN p = 0 THEN NULL ELSE CAST(cp AS DOUBLE) / CAST(p AS DOUBLE) END, {ROUND})
FROM w, t WHERE i = 1 OR np IS DISTINCT FROM pos OR nn IS DISTINCT FROM neg""")
def q_roc_curve_turns(spark, d):
    """The ROC curve without the points in the middle of straight stretches."""
    return round_doubles(M.roc_points(_scored(spark, d), drop_collinear=True))


@query("confusion_matrix", with_views("scored") + """
SELECT coalesce(g.label, c.label) AS label, coalesce(g.prediction, c.prediction) AS prediction,
  CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(label, prediction)) g
FULL OUTER JOIN (SELECT label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n FROM scored GROUP BY ALL) c
  ON g.label = c.label AND g.prediction = c.prediction""")
def q_confusion_matrix(spark, d):
    return M.confusion_matrix(_scored(spark, d))


@query("metrics_report", with_views("scored") + f"""
SELECT 'roc_auc' AS metric, round(auc, {ROUND}) AS value FROM ({AUC_SQL}) a
UNION ALL SELECT 'precision', precision FROM ({PRF_SQL}) b
UNION ALL SELECT 'recall', recall FROM ({PRF_SQL}) b
UNION ALL SELECT 'f1', f1 FROM ({PRF_SQL}) b""")
def q_metrics_report(spark, d):
    return round_doubles(M.metrics_table(_scored(spark, d)))


# --------------------------------------------------------------------------- sampling / splits
def _hash_sql(key: str, salt: str = "") -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{salt}'), 1, 8)) AS BIGINT)"


HASH_SQL = _hash_sql("review_id")


@query("split_hash", with_views("review") + f"""
SELECT review_id, CASE WHEN {HASH_SQL} % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM review""")
def q_split_hash(spark, d):
    return fx.review(spark, d).select("review_id", L.split_label("review_id", 80).alias("split"))


@query("kfold_sizes", with_views("review") + f"""
SELECT CAST({_hash_sql("review_id", L.FOLD_SALT)} % 5 AS INTEGER) AS fold, count(*) AS n FROM review GROUP BY 1""")
def q_kfold_sizes(spark, d):
    f = L.fold_of(fx.review(spark, d).select("review_id"), "review_id", 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("sample_rows", _invariants_sql("rows_of_the_table", "within_five_sigma"))
def q_sample_rows(spark, d):
    """A Bernoulli sample: distinct rows of the table, about the asked share of them."""
    rows, fraction = fx.review(spark, d).select("review_id"), 0.1
    drawn = L.sample_rows(rows, fraction, seed=7)
    n = rows.count()
    m, distinct, inside = drawn.join(rows.withColumn("inside", F.lit(1)), "review_id", "left").agg(
        F.count("*"), F.count_distinct("review_id"), F.count("inside")).first()
    return _invariants(spark, {"rows_of_the_table": m == distinct == inside,
                               "within_five_sigma": abs(m - n * fraction) <= 5 * (n * fraction * (1 - fraction)) ** 0.5})


@query("sample_to_bytes", f"""
SELECT *, CAST(0.25 AS DOUBLE) AS sample_fraction FROM events WHERE {_hash_sql("event_id", L.SAMPLE_SALT)} % 1000000 < 250000""")
def q_sample_to_bytes(spark, d):
    """The fraction for a cap of a quarter of 400 bytes of input, which the rows state."""
    return L.sample_fraction(fx.base(spark, d, "events"), "event_id", L.fraction_for_bytes(400, 100))


@query("sample_measured_bytes", f"""
SELECT * FROM events ORDER BY {_hash_sql("event_id", L.SAMPLE_SALT)}, event_id LIMIT (SELECT CAST(ceil(count(*) / 4.0) AS BIGINT) FROM events)""")
def q_sample_measured_bytes(spark, d):
    """The rows for a quarter of the bytes that the table's files really have."""
    path = f"{d.rstrip('/')}/events.parquet"
    size = IO.input_bytes(spark, path).first().input_bytes
    return L.sample_bytes(IO.read_table(spark, path), path, "event_id", size // 4)


@query("split_random", _invariants_sql("complete", "disjoint", "within_five_sigma"))
def q_split_random(spark, d):
    rows = fx.review(spark, d).select("review_id", "stars")
    train, test = L.split_random(rows, (0.8, 0.2), seed=42)
    n, n_train = rows.count(), train.count()
    both = train.unionByName(test).agg(F.count("*"), F.count_distinct("review_id")).first()
    return _invariants(spark, {"complete": both[0] == n, "disjoint": both[1] == n,
                               "within_five_sigma": abs(n_train - 0.8 * n) <= 5 * (n * 0.16) ** 0.5})


@query("minmax_scale", _features_with(mm="""
SELECT min(normalized_business_review_count) AS lo_b, max(normalized_business_review_count) AS hi_b,
       min(normalized_user_review_count) AS lo_u, max(normalized_user_review_count) AS hi_u FROM features""") + f"""
SELECT review_id,
  round(CASE WHEN hi_b = lo_b THEN 0.5 ELSE (normalized_business_review_count - lo_b) / (hi_b - lo_b) END, {ROUND}) AS scaled_business_review_count,
  round(CASE WHEN hi_u = lo_u THEN 0.5 ELSE (normalized_user_review_count - lo_u) / (hi_u - lo_u) END, {ROUND}) AS scaled_user_review_count
FROM features, mm""")
def q_minmax_scale(spark, d):
    from ridgeline.plans.model import minmax_scale
    f = _features(spark, d, keep=("review_id", "normalized_business_review_count", "normalized_user_review_count"))
    out = minmax_scale(f, ["normalized_business_review_count", "normalized_user_review_count"], prefix="scaled_")
    return round_doubles(out.select(
        "review_id",
        F.col("scaled_normalized_business_review_count").alias("scaled_business_review_count"),
        F.col("scaled_normalized_user_review_count").alias("scaled_user_review_count"),
    ))


# --------------------------------------------------------------------------- sources / sinks


@query("json_scan", with_views("review_dirty") + "SELECT * FROM review_dirty")
def q_json_scan(spark, d):
    """Write review_dirty as JSON lines to the shared folder, read it back by inference."""
    path = scratch_path(spark, "json_scan")
    IO.write_json(_dirty(spark, d), path)
    return IO.read_json(spark, path).select(*DIRTY_COLS)


@query("parquet_scan", "SELECT * FROM customer")
def q_parquet_scan(spark, d):
    return IO.read_table(spark, f"{d.rstrip('/')}/customer.parquet")


@query("parquet_roundtrip", _features_with() + "SELECT * FROM features")
def q_parquet_roundtrip(spark, d):
    """Write the feature table (overwrite) and read it back."""
    path = scratch_path(spark, "trusted")
    IO.write_parquet(_features(spark, d), path)
    return IO.read_table(spark, path)


_ZONE_TABLES = {
    "review_dirty": (DIRTY_COLS, DIRTY_DOUBLES),
    "business_dirty": (("business_id", "name", "stars", "is_open", "latitude", "longitude", "review_count"),
                       ("stars", "latitude", "longitude")),
    "users_dirty": (("user_id", "average_stars", "review_count", "fans", "cool", "funny", "useful", *fx.COMPLIMENTS),
                    ("average_stars",)),
    "checkin": (("business_id", "date"), ()),
    "tip": (("user_id", "business_id", "text", "date", "compliment_count"), ()),
}
# Malformed lines added to every landed table.
BROKEN = 3


def _land(spark, d, names=tuple(_ZONE_TABLES)) -> str:
    """Write the named fixture tables to a fresh landing zone as JSON lines."""
    landing = scratch_path(spark, "landing")
    for name in names:
        path = Z.landing_path(landing, name)
        IO.write_json(fx.VIEWS[name](spark, d), path)
        spark.range(BROKEN).selectExpr("concat('{\"broken\": ', id) AS value").write.mode("append").text(path)
    return landing


@query("clean_zone_counts", with_views(*_ZONE_TABLES) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", rows_before + {BROKEN} AS rows_in, CAST({BROKEN} AS BIGINT) AS malformed, rows_after AS rows_out, "
    f"columns_before AS cols_in, columns_after AS cols_out FROM ({clean_stats_sql(t, cols, dbl, C.DEFAULT_POLICY)}) s"
    for t, (cols, dbl) in _ZONE_TABLES.items()))
def q_clean_zone_counts(spark, d):
    landing = _land(spark, d)
    return Z.clean_zone(spark, landing, scratch_path(spark, "cleaned"), list(_ZONE_TABLES))


@query("json_malformed", with_views("review_dirty") + f"""
SELECT count(*) + {BROKEN} AS n_lines, CAST({BROKEN} AS BIGINT) AS malformed, count(stars) AS with_stars FROM review_dirty""")
def q_json_malformed(spark, d):
    """Every line is read; malformed ones are counted."""
    lines = IO.read_json_lines(spark, Z.landing_path(_land(spark, d, ("review_dirty",)), "review_dirty"))
    return lines.agg(F.count("*").alias("n_lines"), F.count(IO.CORRUPT).alias("malformed"), F.count("stars").alias("with_stars"))


FILES = 7


def _repartitioned(spark, d) -> str:
    path = scratch_path(spark, "repartitioned")
    IO.write_parquet(C.clean(_dirty(spark, d), "validated"), path, partitions=FILES)
    return path


@query("repartition_rows", ORACLE["clean_05"])
def q_repartition_rows(spark, d):
    """Cleaned rows repartitioned to a given number of files, read back."""
    return IO.read_table(spark, _repartitioned(spark, d))


@query("repartition_files", f"SELECT CAST({FILES} AS BIGINT) AS input_files, n FROM (SELECT count(*) AS n FROM ({ORACLE['clean_05']}) c) t")
def q_repartition_files(spark, d):
    path = _repartitioned(spark, d)
    rows = IO.read_table(spark, path).agg(F.count("*")).scalar()
    return IO.input_bytes(spark, path).select("input_files", rows.alias("n"))


@query("feature_profile", _features_with() + "\nUNION ALL\n".join(
    _profile_sql("features", ("is_high_star", "review_text_length", "user_review_bucket"), ("is_high_star", "review_text_length"))))
def q_feature_profile(spark, d):
    cols = ["is_high_star", "review_text_length", "user_review_bucket"]
    return round_doubles(P.profile_long(_features(spark, d, keep=cols).select(*cols), "features"))


@query("stream_clean_zone", ORACLE["clean_05"])
def q_stream_clean_zone(spark, d):
    """The row-local policy as an incremental file stream (available-now trigger); drops
    the columns the batch policy drops, so the result equals clean_05."""
    from ridgeline.streaming.zone_stream import start_clean_stream
    dirty = _dirty(spark, d)
    landing = scratch_path(spark, "stream-landing")
    IO.write_json(dirty, landing)
    dropped = C.sparse_columns(dirty, C.POLICIES["validated"]["max_null_frac"])
    out, ckpt = scratch_path(spark, "stream-cleaned"), scratch_path(spark, "stream-ckpt")
    q = start_clean_stream(spark, landing, out, ckpt, dirty.schema, drop=dropped)
    q.awaitTermination()
    return IO.read_table(spark, out).select(*[c for c in DIRTY_COLS if c not in dropped])


def _land_twice(spark, d):
    """The stream's folders after two landings of review_dirty, each with malformed lines, and its schema.

    The first landing is the rows with text only, so that the sparse columns change with the second."""
    from ridgeline.streaming.zone_state import start_zone_stream
    dirty = _staged_dirty(spark, d)
    landing, cleaned, state = (scratch_path(spark, f"zone-{x}") for x in ("landing", "cleaned", "state"))
    for k, part in enumerate((dirty.where("text IS NOT NULL"), dirty.where("text IS NULL"))):
        IO.write_json(part, f"{landing}/{k}")
        spark.range(k + 1).selectExpr("concat('{\"broken\": ', id) AS value").write.mode("append").text(f"{landing}/{k}")
        start_zone_stream(spark, f"{landing}/*", cleaned, state, dirty.schema).awaitTermination()
    return cleaned, state, dirty.schema


@query("stream_zone_rows", ORACLE["clean_05"])
def q_stream_zone_rows(spark, d):
    """Two landings in a row, the sparse columns decided by the stream's own counts: equal to one batch run."""
    from ridgeline.streaming.zone_state import read_cleaned
    return read_cleaned(spark, *_land_twice(spark, d))


@query("stream_zone_counts", with_views("review_dirty") + f"""
SELECT 'review_dirty' AS "table", rows_before + {BROKEN} AS rows_in, CAST({BROKEN} AS BIGINT) AS malformed, rows_after AS rows_out,
  columns_before AS cols_in, columns_after AS cols_out FROM ({clean_stats_sql("review_dirty", DIRTY_COLS, DIRTY_DOUBLES, C.DEFAULT_POLICY)}) s""")
def q_stream_zone_counts(spark, d):
    from ridgeline.streaming.zone_state import zone_summary
    return zone_summary(spark, "review_dirty", *_land_twice(spark, d))


# --------------------------------------------------------------------------- model
# The model queries run on ``review_signal``, whose target depends on both features.

SIGNAL_SQL = JOINED_SQL.replace("FROM review r", "FROM review_signal r")


def _signal_with(**extra) -> str:
    return with_views("review_signal", "business", "users", extra={
        "joined": SIGNAL_SQL, "targeted": TARGET_SQL, "features": FEATURES_SQL, **extra})


def _signal(spark, d):
    """``(features, held-out rows)``: every row with the columns that a model reads, staged, and the held-out
    rows of the feature table with all their columns."""
    from ridgeline.plans import model as MO
    reviews, business, users = _facts(spark, d)
    reviews, texts, staging = fx.with_signal(reviews), fx.review_texts(spark, d), scratch_path(spark, "signal")
    features = FE.build_features(reviews, business, users, staging=staging, texts=texts,
                                 keep=["review_id", "is_high_star", "class_weight", *MO.FEATURE_COLUMNS])
    _, held_out = L.split_hash(reviews, "review_id", MO.TRAIN_PCT)
    return features, FE.build_features(held_out, business, users, texts=texts, scalars=IO.read_table(spark, f"{staging}-scalars"))


def _fit(spark, d):
    """``(model, features, path of the written predictions, held-out rows)``: fitted anew by every query, once in it."""
    from ridgeline.plans import model as MO
    features, held_out = _signal(spark, d)
    model, pred = MO.train_score(features, parallelism=8, held_out=held_out)
    path = scratch_path(spark, "predictions")
    MO.write_predictions(pred, path)
    return model, features, path, held_out


def _predictions(spark, d):
    """The written predictions, read back: what every evaluation reads."""
    return IO.read_table(spark, _fit(spark, d)[2])


_TEST_SQL = _signal_with(
    keyed=f"SELECT *, {HASH_SQL} % 100 < 80 AS train FROM features",
    mm="""SELECT min(normalized_business_review_count) AS lo_b, max(normalized_business_review_count) AS hi_b,
  min(normalized_user_review_count) AS lo_u, max(normalized_user_review_count) AS hi_u FROM keyed WHERE train""")


@query("predictions", _TEST_SQL + f"""
SELECT review_id, review_stars, text, is_high_star AS label, round(class_weight, {ROUND}) AS class_weight,
  round((normalized_business_review_count - lo_b) / (hi_b - lo_b), {ROUND}) AS scaled_business,
  round((normalized_user_review_count - lo_u) / (hi_u - lo_u), {ROUND}) AS scaled_user
FROM keyed, mm WHERE NOT train""")
def q_predictions(spark, d):
    """Split, label, weight, assembled and scaled features of the written predictions."""
    from pyspark.ml.functions import vector_to_array
    scaled = vector_to_array("scaled_features")
    return round_doubles(_predictions(spark, d).select(
        "review_id", "review_stars", "text", "label", "class_weight",
        scaled[0].alias("scaled_business"), scaled[1].alias("scaled_user")))


_PREDICTION_COLUMNS = ("label", "numeric_features", "scaled_features", "rawPrediction", "probability", "prediction")


@query("model_checks", _invariants_sql(
    "probability_is_sigmoid", "prediction_is_half_or_more", "coefficients_not_zero", "auc_above_three_quarters",
    "auc_near_exact", "reload_scores_alike", "all_columns_written"))
def q_model_checks(spark, d):
    """The fitted model by value: its coefficients give the probabilities, a reloaded copy the same scores."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.functions import vector_to_array

    from ridgeline.plans import model as MO
    model, features, written, held_out = _fit(spark, d)
    pred = IO.read_table(spark, written)
    lr = MO.fitted_stage(model.bestModel, LogisticRegressionModel)
    x, p = vector_to_array("scaled_features"), vector_to_array("probability")[1]
    z = sum((F.lit(float(w)) * x[i] for i, w in enumerate(lr.coefficients)), F.lit(float(lr.intercept)))
    off, wrong = pred.agg(F.max(F.abs(p - 1 / (1 + F.exp(-z)))), F.count_if((p > 0.5) != (F.col("prediction") == 1))).first()
    path = scratch_path(spark, "model")
    MO.save_model(model.bestModel, path)
    again = MO.load_model(path).transform(features).select("review_id", vector_to_array("probability")[1].alias("q"))
    differ = pred.select("review_id", p.alias("p")).join(again, "review_id").agg(F.count_if(F.abs(F.col("p") - F.col("q")) > 1e-12), F.count("*")).first()
    binned, exact = MO.auc_ml(pred), M.auc_exact(MO.flatten_predictions(pred), "label", "probability_1").first()[0]
    return _invariants(spark, {
        "probability_is_sigmoid": off < 1e-9, "prediction_is_half_or_more": wrong == 0,
        "coefficients_not_zero": all(abs(w) > 0.1 for w in lr.coefficients), "auc_above_three_quarters": exact > 0.75,
        "auc_near_exact": abs(binned - exact) < 1e-3, "reload_scores_alike": differ[0] == 0 and differ[1] == pred.count(),
        "all_columns_written": set(pred.columns) == {*held_out.columns, *_PREDICTION_COLUMNS}})


@query("cv_metrics", _TEST_SQL + f"""
SELECT r AS regParam, e AS elasticNetParam, CAST({_hash_sql("review_id", L.FOLD_SALT)} % 5 AS INTEGER) AS fold, count(*) AS n,
  CAST(count_if(is_high_star = 1) AS BIGINT) AS positives, true AS learned, true AS mean_of_folds
FROM keyed, (VALUES (CAST(0.01 AS DOUBLE)), (0.1), (1.0)) a(r), (VALUES (CAST(0.0 AS DOUBLE)), (0.5), (1.0)) b(e)
WHERE train GROUP BY ALL""")
def q_cv_metrics(spark, d):
    """Every setting and fold from the written held-out scores: rows and positives by value, and the AUCs that
    the reported means are made of (no worse than chance; well above it under little regularisation)."""
    from ridgeline.plans import model as MO
    path = scratch_path(spark, "cv-scores")
    model, _ = MO.train_score(_signal(spark, d)[0], parallelism=8, scores_path=path)
    settings = MO.cv_metrics(model).select("regParam", "elasticNetParam", "avg_auc").collect()
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(settings)], "setting int, regParam double, elasticNetParam double, avg_auc double")
    scores = IO.read_table(spark, path)
    auc = MO.fold_auc(scores, scratch_path(spark, "cv-counts"))
    mean = auc.groupBy("setting").agg(F.avg("auc").alias("mean"))
    counted = scores.groupBy("setting", "fold").agg(F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("positives"))
    least = F.when(F.col("regParam") < 0.5, 0.75).otherwise(0.5)
    return counted.join(auc, ["setting", "fold"]).join(mean, "setting").join(F.broadcast(table), "setting").select(
        "regParam", "elasticNetParam", "fold", "n", "positives", (F.col("auc").between(least, 1.0)).alias("learned"),
        (F.abs(F.col("mean") - F.col("avg_auc")) < 1e-12).alias("mean_of_folds"))


@query("auc_ml", _invariants_sql("above_three_quarters", "below_one"))
def q_auc_ml(spark, d):
    from ridgeline.plans import model as MO
    auc = MO.auc_ml(_predictions(spark, d))
    return _invariants(spark, {"above_three_quarters": auc > 0.75, "below_one": auc < 1.0})


@query("feature_importance", "SELECT * FROM (VALUES ('normalized_business_review_count', true), ('normalized_user_review_count', true)) "
       "t(feature, sorted_and_positive)")
def q_feature_importance(spark, d):
    """Both features, by descending magnitude; the target grows with both."""
    from ridgeline.plans import model as MO
    rows = MO.feature_importance(_fit(spark, d)[0].bestModel).collect()
    size = [r.abs_coefficient for r in rows]
    good = size == sorted(size, reverse=True)
    return spark.createDataFrame([(r.feature, good and r.coefficient > 0 and r.abs_coefficient == abs(r.coefficient)) for r in rows],
                                 "feature string, sorted_and_positive boolean")


@query("model_roundtrip", _TEST_SQL + "SELECT review_id, is_high_star AS label, true AS alike FROM keyed WHERE NOT train")
def q_model_roundtrip(spark, d):
    """Save the best pipeline, load it back, score the held-out rows with the copy: alike row by row."""
    from ridgeline.plans import model as MO
    model, features, written, _ = _fit(spark, d)
    path = scratch_path(spark, "model")
    MO.save_model(model.bestModel, path)
    _, test = MO.split_train_test(features)
    copy = MO.flatten_predictions(MO.load_model(path).transform(test)).select("review_id", F.col("probability_1").alias("q"), F.col("prediction").alias("b"))
    own = MO.flatten_predictions(IO.read_table(spark, written))
    alike = (F.abs(F.col("probability_1") - F.col("q")) < 1e-12) & (F.col("prediction") == F.col("b"))
    return own.join(copy, "review_id").select("review_id", "label", alike.alias("alike"))


@query("correlation_ml", ORACLE["correlation"])
def q_correlation_ml(spark, d):
    """Spark ML's Correlation on the same columns; checked against the same SQL."""
    from ridgeline.plans.model import correlation_ml
    out = correlation_ml(_features(spark, d, keep=_CORR_COLS))
    return round_doubles(out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr"))))


@query("evaluation_report", _invariants_sql("roc_auc", "roc_auc_exact", "precision", "recall", "f1"))
def q_evaluation_report(spark, d):
    """The report, written by its sink and read back, against the metrics of the written predictions."""
    from ridgeline.plans import model as MO
    pred = _predictions(spark, d)
    path = scratch_path(spark, "report")
    MO.write_report(MO.evaluation_report(pred), path)
    stored = {r.metric: r.value for r in IO.read_json(spark, path, "metric string, value double").collect()}
    flat = MO.flatten_predictions(pred)
    want = {**M.precision_recall_f1(flat).first().asDict(), "roc_auc": MO.auc_ml(pred),
            "roc_auc_exact": M.auc_exact(flat, "label", "probability_1").first()[0]}
    return _invariants(spark, {k: k in stored and abs(stored[k] - v) < 1e-6 for k, v in want.items()})


@query("model_probability_histogram", _TEST_SQL + "SELECT is_high_star AS label, count(*) AS n, CAST(20 AS BIGINT) AS bins FROM keyed "
       "WHERE NOT train GROUP BY 1")
def q_model_probability_histogram(spark, d):
    """Predicted probability of class 1, 20 shared bins, by true label: every held-out row is in one bin."""
    from ridgeline.plans import model as MO
    bins = H.histogram(MO.flatten_predictions(_predictions(spark, d)), "probability_1", 20, by="label")
    return bins.groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("bins"))


@query("model_roc_curve", _invariants_sql("starts_at_origin", "ends_at_one", "monotone", "area_is_auc"))
def q_model_roc_curve(spark, d):
    from pyspark.sql import Window

    from ridgeline.plans import model as MO
    flat = MO.flatten_predictions(_predictions(spark, d))
    points = M.roc_points(flat, "label", "probability_1")
    order = Window.orderBy("fpr", "tpr")  # at most one point a row of the held-out set: a report, not a plan step
    step = points.select("fpr", "tpr", F.lag("fpr", 1, 0.0).over(order).alias("f"), F.lag("tpr", 1, 0.0).over(order).alias("t"))
    area, back, low, high = step.agg(F.sum((F.col("fpr") - F.col("f")) * (F.col("tpr") + F.col("t")) / 2),
                                     F.count_if(F.col("tpr") < F.col("t")), F.min(F.col("fpr") + F.col("tpr")), F.max(F.col("fpr") + F.col("tpr"))).first()
    exact = M.auc_exact(flat, "label", "probability_1").first()[0]
    return _invariants(spark, {"starts_at_origin": low == 0, "ends_at_one": abs(high - 2) < 1e-12, "monotone": back == 0,
                               "area_is_auc": abs(area - exact) < 1e-9})


@query("model_confusion_matrix", _TEST_SQL + "SELECT is_high_star AS label, count(*) AS n, true AS learned FROM keyed WHERE NOT train GROUP BY 1")
def q_model_confusion_matrix(spark, d):
    """Confusion cells by true label: complete, and more right than wrong in each class."""
    from ridgeline.plans import model as MO
    cells = M.confusion_matrix(MO.flatten_predictions(_predictions(spark, d)), "label", "prediction")
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return cells.groupBy("label").agg(F.sum("n").alias("n"), (right * 2 > F.sum("n")).alias("learned"))


@query("model_probability_density", "SELECT * FROM (VALUES (0, true), (1, true)) t(label, integrates_to_one)")
def q_model_probability_density(spark, d):
    """Density curve of the predicted probability per true label, over a grid wide enough to hold its mass."""
    from ridgeline.plans import model as MO
    curve = H.density(MO.flatten_predictions(_predictions(spark, d)), "probability_1", by="label", cut=4.0)
    step = (F.max("x") - F.min("x")) / (H.DEFAULT_POINTS - 1)
    return curve.groupBy("label").agg((F.abs(F.sum("density") * step - 1) < 0.01).alias("integrates_to_one"))
