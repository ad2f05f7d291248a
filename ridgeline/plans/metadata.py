"""Metadata document (S9): per table, the profile metrics and the correlation matrix of
its int / double columns, as one long table, plus the schema; written as JSON lines.

Each part is one aggregate pass per table (the reference runs two describe jobs, one
audit, one job per column for distinct counts and one correlation job per table).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.profile import CORRELATION_TYPES, correlation_long, profile_long
from ridgeline.sources.io import schema_table


def metadata_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, column, metric, value, text)``: profile metrics, and ``corr:<other column>``
    for every pair of the table's int / double columns."""
    parts = []
    for name, df in tables.items():
        parts.append(profile_long(df, name))
        corr = correlation_long(df, types=CORRELATION_TYPES)
        parts.append(corr.select(
            F.lit(name).alias("table"), F.col("x").alias("column"),
            F.concat(F.lit("corr:"), F.col("y")).alias("metric"), F.col("corr").alias("value"),
            F.lit(None).cast("string").alias("text"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_metadata(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write ``path/metrics`` (the long table) and ``path/schema`` as JSON lines."""
    metadata_table(tables).write.mode("overwrite").json(f"{path.rstrip('/')}/metrics")
    schemas = [schema_table(df).select(F.lit(n).alias("table"), "*") for n, df in tables.items()]
    out = schemas[0]
    for s in schemas[1:]:
        out = out.unionByName(s)
    out.write.mode("overwrite").json(f"{path.rstrip('/')}/schema")
