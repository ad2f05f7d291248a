"""Readers, writers and table inspection (S1-S4, S6-S8)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              mode: str = "PERMISSIVE", sampling_ratio: float = 1.0) -> DataFrame:
    """JSON-lines scan.  Without a schema Spark infers one, which is one extra pass over
    the files; ``sampling_ratio < 1`` infers from a sample of the lines instead (at
    large scale, or pass the schema of a previous run).

    ``PERMISSIVE`` keeps every line: a malformed one is a row of NULLs with its text in
    ``_corrupt_record`` (a column that inference adds when there is one, or that the schema
    names).  ``DROPMALFORMED`` leaves such lines out.
    """
    reader = spark.read.option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio < 1.0:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON-lines scan that always has ``_corrupt_record`` as its last column (NULL for good lines).

    Spark refuses a query that reads no other column of raw JSON; aggregate another one with it."""
    if schema is None:
        schema = read_json(spark, path).schema
    fields = [f for f in schema.fields if f.name != CORRUPT]
    return read_json(spark, path, StructType([*fields, StructField(CORRUPT, StringType())]))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (vectorised; filters and projections reach the reader)."""
    return spark.read.parquet(path)


def load_tables(spark: SparkSession, base: str, names: Iterable[str],
                suffix: str = ".parquet") -> dict[str, DataFrame]:
    """Named tables under one base path, as a dict of lazy DataFrames."""
    base = base.rstrip("/")
    return {n: spark.read.parquet(f"{base}/{n}{suffix}") for n in names}


#: Codec of Parquet files that may hold texts: its window covers a page, so equal texts of near rows are stored about once.
PARQUET_CODEC = "zstd"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partitions: int | None = None) -> None:
    """Parquet sink.  By default the plan's own partitioning is written as is.

    ``partitions`` repartitions the rows evenly to that many files (one full shuffle)."""
    (df.repartition(partitions) if partitions else df).write.mode(mode).parquet(path, compression=PARQUET_CODEC)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Bucketed Parquet sink: rows dealt into ``buckets`` by the hash of ``key`` and sorted by it, one file a
    bucket, under ``path`` and as ``table`` of the session's catalog (replaced, if there is one); returns the table.

    Tables bucketed alike by their join key are joined without a shuffle of either, every time they are
    read.  Writing shuffles the rows once.  A hot key makes a large bucket, which a join over buckets does
    not split: such a fact table is better joined by a plain shuffle, whose skewed partitions are."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .format("parquet").option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """JSON-lines sink, a file a partition.  Readers unpack the files by their names; one of them is one task's."""
    df.write.mode(mode).json(path, compression=compression)


def input_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(input_bytes, input_files)`` of a path, from the file listing (no file is opened)."""
    files = spark.read.format("binaryFile").load(path).select("length")
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("input_bytes"),
                     F.count(F.lit(1)).alias("input_files"))


def schema_table(df: DataFrame) -> DataFrame:
    """``(pos, column, type)`` for every column: the schema, as a (tiny) DataFrame."""
    spark = df.sparkSession
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "pos int, column string, type string")


def preview(df: DataFrame, n: int = 5, order_by: str | list[str] | None = None) -> DataFrame:
    """First ``n`` rows by a key (TakeOrdered: a bounded top-n per task, no full sort)."""
    if order_by is None:
        return df.limit(n)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)
