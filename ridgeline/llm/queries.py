"""The operators bound to the test tables: query name -> plan, and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import licenses
from ridgeline.llm.common import on_workers
from ridgeline.llm.embeddings import near_vectors
from ridgeline.llm.hard_negatives import mine_negatives
from ridgeline.llm.language import fit_language, predict_language
from ridgeline.llm.licenses import scan_licenses
from ridgeline.llm.minhash import near_duplicates
from ridgeline.llm.mixing import mix_sources
from ridgeline.llm.packing import pack_documents
from ridgeline.llm.periodic import periodic_runs, run_lines, strongest
from ridgeline.llm.quality import fit_quality, score_quality
from ridgeline.llm.suffix_dedup import remove_repeats, sha256
from ridgeline.llm.token_counts import count_tokens
from ridgeline.llm.token_files import token_table
from ridgeline.llm.tokens import tokenizer_path
from ridgeline.llm.winnowing import fingerprint_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        on_workers(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), end_id=2)


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)


@query
def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), size=4, percent=80)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sha256(remove_repeats(documents(spark, sf_dir)))


def remainder(modulus: int) -> Column:
    """``crc32`` of the id's decimal text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(4) != 2).select("doc_id", F.col("quality").alias("label"))
    scored = score_quality(docs, fit_quality(docs, labels), limit=0.7)
    return scored.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    predicted = predict_language(docs, fit_language(docs, remainder(5) != 0))
    return predicted.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), limit=0.98)


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` whose ids have a ``crc32`` divisible by 10 get a periodic end made of their own words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(F.pmod(h, F.lit(10)) == 0, F.regexp_extract_all(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", (h / 10).cast("long").alias("_g"), words.alias("_words"))
    cut = cut.select("*", F.size("_words").cast("long").alias("_n"), F.expr("IF(size(_words) > 0, _g % size(_words), 0)").alias("_a"))
    cut = cut.select("*", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).alias("_p"))
    return cut.selectExpr("doc_id", """IF(_n > 0, array_join(transform(sequence(0L, _n - 1),
        i -> element_at(_words, CAST(1 + IF(i < _a, i, _a + (i - _a) % _p) AS INT))), ' '), text) AS text""")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(documents(spark, sf_dir)), least=6, times=4)
    return found.withColumn("_best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length DIV _best.period").alias("exponent_milli"),
        F.sha2(run_lines(F.col("runs")).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100, scale=256.0)


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), limit=4096)


ORACLE["op8_license_scan"] = licenses.oracle_sql()
ORACLE["op12_hard_negatives"] = """
WITH r AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
    FROM r a JOIN r ON r.vec_id <> a.vec_id AND len(r.v) = len(a.v)
    WHERE a.vec_id % 100 = 0),
p AS (
    SELECT anchor_id, other_id, score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
    s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""
