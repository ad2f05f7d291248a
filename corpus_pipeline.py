"""A corpus from raw documents to packed sequences: five stages, each one of the operators.

Each stage reads what the one before wrote, works on all of it and, but for the last, returns
the columns of ``documents``.  Rows with a null ``doc_id``, null or empty texts, repeated rows
and extra columns are handled as the operators state.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import lean_workers, on_workers, stored
from ridgeline.llm.language import fit_language, with_language
from ridgeline.llm.minhash import near_duplicates
from ridgeline.llm.mixing import mix_sources, take_copies
from ridgeline.llm.packing import pack_documents
from ridgeline.llm.suffix_dedup import without_repeats
from ridgeline.llm.tokens import tokenizer_path
from ridgeline.session import drop_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(fn: Stage) -> Stage:
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        on_workers(spark)
        lean_workers(spark)
        return fn(spark, docs, sf_dir)

    return run_stage


@stage
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (``und``: null text or no letter) go; ``lang`` is the prediction.

    Learned from the documents that carry a language; without any of them every document is ``und``.
    """
    model = fit_language(docs)
    found = with_language(docs, model).where("lang_pred != 'und'")
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


@stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (five words, similarity 0.8): the smallest ``doc_id`` of each group stays, once.

    Rows with a null ``doc_id`` stay.
    """
    groups = near_duplicates(docs, size=5, percent=80)
    gone = groups.where("NOT kept").select(F.col("doc_id").alias("_gone"))
    numbered = docs.where("doc_id IS NOT NULL").join(gone, F.col("doc_id") == F.col("_gone"), "left_anti").dropDuplicates(["doc_id"])
    return numbered.union(docs.where("doc_id IS NULL"))


@stage
def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: strings of 100 bytes that occur earlier are cut out of the texts."""
    return without_repeats(docs)


@stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: sources weigh 1, 2, 3 in turn; a document stays as often as the mix takes it (0 to 3 times)."""
    return take_copies(docs, mix_sources(docs))


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing (last): where each piece of each document lies in the sequences of 4096 ids."""
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", repeats_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: No SQL twin: the stages run trained models, suffix sorting and a tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's output is written and read back as the next one's input, then removed."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES[:-1]:
        before = path
        docs, path = stored(function(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
        if before:
            drop_path(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
