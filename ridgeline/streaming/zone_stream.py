"""Incremental landing -> cleaned job with Structured Streaming.

The row-local part of cleaning (name normalisation, listed column drops, validity
rules, null-row removal) needs no global statistic, so it runs unchanged on a file
stream.  The sparse-column step needs null fractions over the whole table: this stream takes
the dropped columns as a parameter (for example the list a batch
:func:`ridgeline.operators.clean.sparse_columns` run produced); :mod:`ridgeline.streaming.zone_state`
keeps the counts and decides by itself.

Malformed lines are left out and counted: every progress report of the stream has the
``landed`` metrics ``rows`` and ``malformed`` of its batch (see :func:`landed_counts`).

The stream reads JSON files with a fixed schema (no inference on a stream), writes
Parquet, and keeps its progress in a checkpoint under the shared folder, so a restarted
job resumes and files are written exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StringType, StructType

from ridgeline.operators.clean import drop_columns, drop_null_rows, normalise_names, validity_filter
from ridgeline.sources.io import CORRUPT
from ridgeline.sources.zone import good_lines


def clean_rows(df: DataFrame, drop: Sequence[str] = (), validate: bool = True) -> DataFrame:
    """Row-local cleaning (valid on batch and streaming frames)."""
    out = drop_columns(normalise_names(df), drop)
    if validate:
        out = validity_filter(out)
    return drop_null_rows(out)


def start_clean_stream(spark: SparkSession, landing: str, cleaned: str, checkpoint: str,
                       schema: StructType, drop: Sequence[str] = (), validate: bool = True,
                       available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream.  ``available_now`` processes what has landed and stops (a
    scheduled incremental batch); otherwise it keeps running on new files."""
    fields = [f for f in schema.fields if f.name != CORRUPT]
    reader = spark.readStream.schema(StructType([*fields, StructField(CORRUPT, StringType())])).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.json(landing).observe("landed", F.count(F.lit(1)).alias("rows"), F.count(F.col(CORRUPT)).alias("malformed"))
    stream = clean_rows(good_lines(landed), drop, validate)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(cleaned)


def landed_counts(query: StreamingQuery) -> tuple[int, int]:
    """Lines and malformed lines of the batches in the query's recent progress."""
    seen = [p.observedMetrics["landed"] for p in query.recentProgress if "landed" in p.observedMetrics]
    return sum(m["rows"] or 0 for m in seen), sum(m["malformed"] or 0 for m in seen)
