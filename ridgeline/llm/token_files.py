"""Token-id files: Parquet list columns in id order, for selective token and metadata reads.

Layout of a token table: ``doc_id``, ``n_tokens`` and ``ids`` (list of int).  Files cover
disjoint, ascending ``doc_id`` ranges and rows ascend within a file, so the min/max of each
row group and the page index let a reader of some documents skip the rest; the metadata
columns can be read without the ids.  ``ids`` is dictionary-encoded while its page
dictionary fits (``dictionary_page_bytes``) and DELTA_BINARY_PACKED beyond that; ``doc_id``
and ``n_tokens`` skip the dictionary and are delta-encoded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgeline.llm.tokens import encoder
from ridgeline.session import scratch_path


def encode_documents(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every text, rows in ascending ``doc_id``.

    The texts are range-partitioned by ``doc_id`` before encoding, so that the sampling pass
    of the range exchange reads ids only and every text is encoded once.  A null or empty
    text has the end id alone; null ``doc_id`` rows come first; repeated rows stay.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_file)
        for batch in batches:
            values, offsets = coder.encode(batch.column(1), end_id)
            ids = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(values.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), ids], ["doc_id", "n_tokens", "ids"])

    ordered = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
               .repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first()))
    return ordered.mapInArrow(encoded, "doc_id long, n_tokens long, ids array<int>")


def write_token_files(encoded: DataFrame, path: str, row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10,
                      dictionary_page_bytes: int = 256 << 10) -> None:
    """Write ``doc_id, n_tokens, ids`` in the order given, one file per partition."""
    (encoded.write
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", page_bytes)
     .option("parquet.dictionary.page.size", dictionary_page_bytes)
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#n_tokens", "false")
     .option("compression", "zstd")
     .parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)


def token_starts(tokens: DataFrame) -> DataFrame:
    """Each row with ``start``: the ids of all rows before it, in ``doc_id`` order.

    Files hold disjoint ranges, so a file's offset is the sum of the files before it: one
    row per file is ordered globally, and rows are ordered within their file only.  Rows of
    one ``doc_id`` share a file and are ordered by their size and ids' digest.
    """
    rows = tokens if "_file" in tokens.columns else tokens.withColumn("_file", F.input_file_name())
    files = rows.groupBy("_file").agg(F.sum("n_tokens").alias("_n"), F.min("doc_id").alias("_low"),
                                      F.count("doc_id").alias("_ids"))
    before = files.select("_file", F.coalesce(F.sum("_n").over(
        Window.orderBy(F.col("_low").asc_nulls_first(), "_ids", "_file").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    tie = [c for c in ("n_tokens", "ids_crc32") if c in rows.columns]
    in_file = Window.partitionBy("_file").orderBy(F.col("doc_id").asc_nulls_first(), *tie)
    return (rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(
                in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .join(before, "_file").withColumn("start", F.col("_before") + F.col("_in"))
            .drop("_file", "_in", "_before"))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, _file`` of rows read from token files."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            at = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4").view(np.uint8))
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
                ["_file", "doc_id", "n_tokens", "ids_crc32"])

    return tokens.select(F.input_file_name().alias("_file"), "doc_id", "n_tokens", "ids").mapInArrow(
        digests, "_file string, doc_id long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer_file: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and return, from the files, ``doc_id, start, n_tokens, ids_crc32``.

    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(encode_documents(docs, tokenizer_file, end_id), path)
    return token_starts(with_crc32(read_token_files(spark, path))).select("doc_id", "start", "n_tokens", "ids_crc32")
