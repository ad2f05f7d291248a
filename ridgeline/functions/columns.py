"""Column expressions shared by the operators.

All are plain ``pyspark.sql.functions`` compositions, so they stay inside whole-stage
codegen and run unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binarise(c: str | Column, at: float) -> Column:
    """1 when ``c >= at``, else 0; NULL goes to 0 (``when/otherwise``)."""
    return F.when(_c(c) >= F.lit(at), F.lit(1)).otherwise(F.lit(0))


def bucketise(c: str | Column, cuts: Sequence[float], names: Sequence[str]) -> Column:
    """``names[i]`` for the first ``c < cuts[i]``, else ``names[-1]``.

    A NULL input fails every ``<`` test and lands in the last bucket, as a
    ``when`` chain does.
    """
    if len(names) != len(cuts) + 1:
        raise ValueError("need exactly one more name than cut")
    expr = F.when(_c(c) < F.lit(cuts[0]), F.lit(names[0]))
    for cut, name in zip(cuts[1:], names[1:-1]):
        expr = expr.when(_c(c) < F.lit(cut), F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def geo_round(c: str | Column, digits: int = 2) -> Column:
    """Round half-up to ``digits`` places (grid cell of a coordinate)."""
    return F.round(_c(c), digits)


def text_length(c: str | Column = "text") -> Column:
    """Length in characters."""
    return F.length(_c(c))


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or NULL (no ANSI error)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def null_flag(c: str | Column) -> Column:
    """1 for NULL, else 0."""
    return _c(c).isNull().cast("int")


def hash_unit(key: str | Column, modulus: int, salt: str = "") -> Column:
    """Stable bucket ``0..modulus-1`` of a key: first 32 bits of MD5 of its text form and ``salt``.

    Draws that must be independent of each other (a split, folds within its train part, a
    sample) use different salts.  Independent of partitioning, task retries and engine, so a split or a fold
    assignment recomputed after an executor loss is the same.
    """
    hexpart = F.substring(F.md5(F.concat(_c(key).cast("string"), F.lit(salt))), 1, 8)
    return (F.conv(hexpart, 16, 10).cast("bigint") % F.lit(modulus)).cast("int")


def with_stats(df: DataFrame, stats: DataFrame, name: str = "_s") -> DataFrame:
    """Attach a one-row aggregate to every row as one struct column ``name``.

    The struct is a scalar subquery (``DataFrame.scalar()``): Spark runs it once per
    query and inlines the value, so the statistics reach every row without a join and
    without a collect.  Read fields with ``F.col(f"{name}.field")`` and drop ``name``
    afterwards.  ``stats`` must have exactly one row (a global aggregate)."""
    sub = stats.select(F.struct(*[F.col(c) for c in stats.columns]).alias(name)).scalar()
    return df.withColumn(name, sub)
