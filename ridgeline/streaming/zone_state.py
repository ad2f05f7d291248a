"""Landing -> cleaned job as a stream whose sparse-column rule holds over all that has landed.

Every micro-batch stages its good lines and stores what it counted: rows, malformed lines and
NULLs per column.  The counts of all batches add up to the null fractions of the whole table, so
after any number of landings the cleaned table equals one batch run over all of them.

Layout under ``state``: ``staged/batch=N`` (good rows), ``counts/batch=N`` (a row per column) and
``decisions/batch=N`` (the sparse columns after batch N, and the version of the cleaned table that has
them left out).  While the sparse columns stay the same, a batch only appends its own cleaned rows to
the current version; when they change, the staged rows of all batches are cleaned anew into a version
of its own.  The decision is written last, and readers go by it, so they never see half a batch.
Every step overwrites its own batch's folder: a batch that is tried again gives the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ridgeline.operators.clean import DEFAULT_POLICY, POLICIES, clean, sparse_columns
from ridgeline.session import path_exists
from ridgeline.sources.io import CORRUPT, PARQUET_CODEC
from ridgeline.sources.zone import SUMMARY, Counts, stage_lines

COUNTS = "rows bigint, malformed bigint, column string, position int, nulls bigint, batch bigint"
DECISIONS = "version bigint, dropped array<string>, batch bigint"


def _stored(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Rows stored so far; none before the first batch."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def merged_counts(spark: SparkSession, state: str, up_to: int | None = None) -> Counts:
    """The counts of all batches (up to one, included), added up."""
    rows = _stored(spark, f"{state}/counts", COUNTS)
    if up_to is not None:
        rows = rows.where(F.col("batch") <= up_to)
    total = rows.groupBy("position", "column").agg(F.sum("rows"), F.sum("malformed"), F.sum("nulls")).orderBy("position").collect()
    if not total:
        return Counts(0, 0, {})
    return Counts(total[0][2], total[0][3], {r.column: r[4] for r in total})


def _decision(spark: SparkSession, state: str, before: int | None = None):
    rows = _stored(spark, f"{state}/decisions", DECISIONS)
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    return rows.orderBy(F.desc("batch")).first()


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("batch", LongType())])


def add_batch(lines: DataFrame, number: int, cleaned: str, state: str, policy: str = DEFAULT_POLICY) -> None:
    """Take in one batch of landed lines (with ``_corrupt_record``); the lines are read once."""
    spark = lines.sparkSession
    schema = lines.drop(CORRUPT).schema
    counts = stage_lines(lines, f"{state}/staged/batch={number}")
    kept = [(counts.rows, counts.malformed, c, i, n) for i, (c, n) in enumerate(counts.nulls.items())]
    (spark.createDataFrame(kept, COUNTS.rsplit(",", 1)[0]).coalesce(1)
     .write.mode("overwrite").parquet(f"{state}/counts/batch={number}"))

    total = merged_counts(spark, state, number)
    limit = POLICIES[policy]["max_null_frac"]
    staged = spark.read.schema(_with_batch(schema)).parquet(f"{state}/staged").where(F.col("batch") <= number)
    dropped = sorted(sparse_columns(staged.drop("batch"), limit, total.null_row)) if limit is not None else []
    last = _decision(spark, state, number)
    if last is not None and list(last.dropped) == dropped:
        version, rows = last.version, staged.where(F.col("batch") == number)
    else:
        version, rows = number, staged
    # the batch number is a partition column, not one of the table's: it is no NULL and has no rule
    null_row = {**total.null_row, "batch": 0}
    out = clean(rows, policy, null_row=null_row)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{cleaned}/version={version}", compression=PARQUET_CODEC)
    (spark.createDataFrame([(version, dropped)], DECISIONS.rsplit(",", 1)[0]).coalesce(1)
     .write.mode("overwrite").parquet(f"{state}/decisions/batch={number}"))


def start_zone_stream(spark: SparkSession, landing: str, cleaned: str, state: str, schema: StructType,
                      policy: str = DEFAULT_POLICY, available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream over the JSON files under ``landing``; its progress lies in ``state/checkpoint``.

    ``available_now`` takes in what has landed and stops; otherwise the stream keeps running."""
    fields = [f for f in schema.fields if f.name != CORRUPT]
    reader = spark.readStream.schema(StructType(fields).add(CORRUPT, "string")).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.json(landing).writeStream.option("checkpointLocation", f"{state}/checkpoint")
              .foreachBatch(lambda lines, number: add_batch(lines, number, cleaned, state, policy)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_cleaned(spark: SparkSession, cleaned: str, state: str, schema: StructType) -> DataFrame:
    """The cleaned table after the last finished batch; without one, an empty table of ``schema``."""
    last = _decision(spark, state)
    columns = [f for f in schema.fields if f.name != CORRUPT and (last is None or f.name not in last.dropped)]
    if last is None:
        return spark.createDataFrame([], StructType(columns))
    rows = spark.read.schema(_with_batch(StructType(columns))).parquet(f"{cleaned}/version={last.version}")
    return rows.where(F.col("batch") <= last.batch).drop("batch")


def zone_summary(spark: SparkSession, name: str, cleaned: str, state: str, schema: StructType) -> DataFrame:
    """The row that :func:`ridgeline.sources.zone.clean_zone` gives for one batch run over all that has landed."""
    total = merged_counts(spark, state)
    out = read_cleaned(spark, cleaned, state, schema)
    return spark.createDataFrame([(name, total.rows, total.malformed, out.count(), len([c for c in schema.names if c != CORRUPT]), len(out.columns))], SUMMARY)
