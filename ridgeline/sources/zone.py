"""Landing (JSON) -> cleaned (Parquet) zone job (S5, S6).

Per table, after schema inference (none if the caller gives the schema), the JSON is read
once: the pass that stages the good lines as Parquet also counts rows, malformed lines and the
NULLs of every column (an ``Observation`` on the write).  These counts decide the sparse columns,
and the second step rewrites the staged Parquet: it reads only the columns that stay, and the row
rules reach its scan as pushed filters.  The staged folder is removed at the end.

The observed write has no shuffle, so each of its tasks counts once however often it is tried.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridgeline.operators.clean import DEFAULT_POLICY, clean
from ridgeline.session import drop_path, scratch_path
from ridgeline.sources.io import CORRUPT, read_json_lines, write_parquet

SUMMARY = "table string, rows_in bigint, malformed bigint, rows_out bigint, cols_in int, cols_out int"


class Counts(NamedTuple):
    """What the staging pass saw: all lines, malformed ones, and the NULLs of each column in good lines."""

    rows: int
    malformed: int
    nulls: dict[str, int]

    @property
    def null_row(self) -> dict[str, int]:
        """In the form of :func:`ridgeline.operators.clean.null_count_row`."""
        return {"__rows": self.rows - self.malformed, **self.nulls}


def landing_path(landing: str, name: str) -> str:
    return f"{landing.rstrip('/')}/{name}.json"


def cleaned_path(cleaned: str, name: str) -> str:
    return f"{cleaned.rstrip('/')}/{name}.parquet"


def good_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def stage_lines(lines: DataFrame, path: str) -> Counts:
    """Write the good lines of a JSON scan (with ``_corrupt_record``) to ``path``, counting in the same pass."""
    columns = [c for c in lines.columns if c != CORRUPT]
    seen = Observation()
    good = F.col(CORRUPT).isNull()
    # an empty input gives no rows to observe: NULL sums count as 0
    counted = lines.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(F.col(CORRUPT)).alias("malformed"),
        *[F.count_if(good & F.col("`" + c.replace("`", "``") + "`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    write_parquet(good_lines(counted), path)
    got = seen.get
    return Counts(got["rows"] or 0, got["malformed"] or 0, {c: got[f"n{i}"] or 0 for i, c in enumerate(columns)})


def rewrite_staged(staged: DataFrame, counts: Counts, path: str, policy: str = DEFAULT_POLICY, partitions: int | None = None) -> tuple[int, int]:
    """Clean staged rows into ``path`` by the counts of their staging; rows (from the footers) and columns written."""
    out = clean(staged, policy, null_row=counts.null_row)
    write_parquet(out, path, partitions=partitions)
    return staged.sparkSession.read.schema(out.schema).parquet(path).count(), len(out.columns)


def clean_table(spark: SparkSession, landing: str, cleaned: str, name: str, policy: str = DEFAULT_POLICY,
                eda_path: str | None = None, schema: StructType | None = None, partitions: int | None = None) -> tuple:
    """Clean one landed table; returns its row of the summary.

    With ``eda_path``, first write its profile there as JSON lines, over all good rows (read from
    the staged Parquet).  A malformed line is counted, in ``rows_in`` too, and not written.
    ``partitions`` sets the number of files written."""
    lines = read_json_lines(spark, landing_path(landing, name), schema)
    stage = scratch_path(spark, f"staged-{name}")
    try:
        counts = stage_lines(lines, stage)
        staged = spark.read.schema(lines.drop(CORRUPT).schema).parquet(stage)
        if eda_path:
            from ridgeline.operators.profile import profile_long

            profile_long(staged, name).write.mode("overwrite").json(f"{eda_path.rstrip('/')}/{name}")
        written, columns = rewrite_staged(staged, counts, cleaned_path(cleaned, name), policy, partitions)
    finally:
        drop_path(spark, stage)
    return (name, counts.rows, counts.malformed, written, len(staged.columns), columns)


def clean_zone(spark: SparkSession, landing: str, cleaned: str, names: Iterable[str], policy: str = DEFAULT_POLICY,
               eda_path: str | None = None, schemas: Mapping[str, StructType] | None = None,
               partitions: int | None = None) -> DataFrame:
    """Clean every named table; return ``(table, rows_in, malformed, rows_out, cols_in, cols_out)``."""
    rows = [clean_table(spark, landing, cleaned, n, policy, eda_path, (schemas or {}).get(n), partitions) for n in names]
    return spark.createDataFrame(rows, SUMMARY)
