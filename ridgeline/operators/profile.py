"""Profiling (P1-P10, S9): counts, null audit, numeric summaries, distincts, correlation.

Each profile is a single aggregate pass over the table (the reference runs one job
per column for null tests and distinct counts).  Long ("tidy") outputs use
``unpivot`` on the one aggregate row, so they stay lazy and need no driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridgeline.functions.columns import with_stats
from ridgeline.operators.clean import numeric_columns

NUMERIC_TYPES = ("int", "bigint", "float", "double")
# The reference's correlation matrix takes only these two type names.
CORRELATION_TYPES = ("int", "double")


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def ident(c: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + c.replace("`", "``") + "`"


def text(v: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stack(rows: Sequence[Sequence[str]], names: Sequence[str]) -> str:
    """``stack`` expression turning one wide row into ``len(rows)`` long rows."""
    return f"stack({len(rows)}, {', '.join(x for r in rows for x in r)}) AS ({', '.join(names)})"


# Wide, column-by-column profiles are written as SQL expression text and handed to
# ``selectExpr`` in one call: the JVM parses them, instead of one Py4J round trip per
# Column node (thousands for a wide table).  The plans are the same.

def row_count(df: DataFrame, name: str | None = None) -> DataFrame:
    out = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return out.select(F.lit(name).alias("table"), "n_rows") if name is not None else out


def _nulls(c: str) -> str:
    return f"CAST(coalesce(sum(CAST(isnull({ident(c)}) AS INT)), 0) AS BIGINT)"


def null_counts(df: DataFrame) -> DataFrame:
    """Wide: one row, NULL count per column (bigint; 0 on an empty table)."""
    return df.selectExpr(*[f"{_nulls(c)} AS {ident(c)}" for c in df.columns])


def null_audit(df: DataFrame) -> DataFrame:
    """Long: ``(column, nulls, null_frac)``; fraction NULL on an empty table."""
    cols = df.columns
    wide = df.selectExpr("count(1) AS __rows", *[f"{_nulls(c)} AS n{i}" for i, c in enumerate(cols)])
    long = wide.selectExpr("__rows", _stack([(text(c), f"n{i}") for i, c in enumerate(cols)], ["column", "nulls"]))
    return long.selectExpr("column", "nulls",
                           "try_divide(CAST(nulls AS DOUBLE), CAST(__rows AS DOUBLE)) AS null_frac")


def numeric_stats(df: DataFrame, types: Sequence[str] = NUMERIC_TYPES) -> DataFrame:
    """Wide: ``{c}_min`` for all numeric columns, then maxes, means, sample stddevs.

    A table without numeric columns gives an empty result without columns."""
    cols = numeric_columns(df, types)
    if not cols:
        return df.sparkSession.createDataFrame([], StructType())
    exprs = []
    for fn, suffix in (("min", "min"), ("max", "max"), ("avg", "mean"), ("stddev_samp", "stddev")):
        exprs += [f"{fn}({ident(c)}) AS {ident(c + '_' + suffix)}" for c in cols]
    return df.selectExpr(*exprs)


def date_range(df: DataFrame, c: str = "date") -> DataFrame:
    """``min_date``, ``max_date`` (string columns compare lexicographically); no row if there is no such column."""
    if c not in df.columns:
        return df.sparkSession.createDataFrame([], "min_date string, max_date string")
    return df.agg(F.min(_q(c)).alias("min_date"), F.max(_q(c)).alias("max_date"))


def text_length_stats(df: DataFrame, c: str = "text") -> DataFrame:
    """Minimum, maximum, mean and sample stddev of the length; no row if there is no such column."""
    if c not in df.columns:
        return df.sparkSession.createDataFrame([], "min_length int, max_length int, mean_length double, stddev_length double")
    n = F.length(_q(c))
    return df.agg(
        F.min(n).alias("min_length"),
        F.max(n).alias("max_length"),
        F.mean(n).alias("mean_length"),
        F.stddev(n).alias("stddev_length"),
    )


def describe_long(df: DataFrame) -> DataFrame:
    """Spark's ``describe()`` (count, mean, stddev, min, max as strings) in long form."""
    d = df.describe()
    value_cols = [c for c in d.columns if c != "summary"]
    return d.unpivot("summary", value_cols, "column", "value").select(
        "column", F.col("summary").alias("metric"), "value"
    )


def describe_numeric(df: DataFrame, types: Sequence[str] = NUMERIC_TYPES) -> DataFrame:
    """Typed describe of numeric columns: ``(column, count, mean, stddev, min, max)``.

    One aggregate pass, then the single row is unpivoted; no row without a numeric column."""
    cols = numeric_columns(df, types)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, count bigint, mean double, stddev double, min double, max double")
    exprs = []
    for i, c in enumerate(cols):
        x = f"CAST({ident(c)} AS DOUBLE)"
        exprs += [f"count({x}) AS c{i}", f"avg({x}) AS m{i}", f"stddev_samp({x}) AS s{i}",
                  f"min({x}) AS lo{i}", f"max({x}) AS hi{i}"]
    wide = df.selectExpr(*exprs)
    rows = [(text(c), f"c{i}", f"m{i}", f"s{i}", f"lo{i}", f"hi{i}") for i, c in enumerate(cols)]
    return wide.selectExpr(_stack(rows, ["column", "count", "mean", "stddev", "min", "max"]))


# A longer string takes part in distinct counts as its SHA-256 digest.
DIGEST_ABOVE = 64


def _distinct(c: str) -> str:
    """Distinct values of ``c`` with NULL counted as one value: the wrapping struct is never NULL."""
    return f"count(DISTINCT named_struct('v', {ident(c)}))"


def _approx_distinct(c: str, rsd: float) -> str:
    return (f"CAST(approx_count_distinct({ident(c)}, {rsd}) + "
            f"coalesce(max(CAST(isnull({ident(c)}) AS INT)), 0) AS BIGINT)")


_NO_KEY = ("CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)")


def _value_key(c: str, dtype: str) -> tuple[str, str, str] | None:
    """A value as (bigint, double, string), of which one is not NULL unless the value is; None for types without such a key."""
    v, (no_long, no_double, no_string) = ident(c), _NO_KEY
    if dtype in ("tinyint", "smallint", "int", "bigint", "boolean"):
        return f"CAST({v} AS BIGINT)", no_double, no_string
    if dtype == "date":
        return f"CAST(unix_date({v}) AS BIGINT)", no_double, no_string
    if dtype == "timestamp":
        return f"unix_micros({v})", no_double, no_string
    if dtype in ("float", "double"):
        return no_long, f"CAST({v} AS DOUBLE)", no_string
    if dtype == "string":
        return no_long, no_double, f"CASE WHEN length({v}) > {DIGEST_ABOVE} THEN concat('sha256:', sha2({v}, 256)) ELSE {v} END"
    if dtype.startswith("decimal") or dtype == "timestamp_ntz":
        return no_long, no_double, f"CAST({v} AS STRING)"
    return None


def _exact_distinct(df: DataFrame) -> DataFrame:
    """``(position, n_distinct)`` of every column, NULL counted as one value; no row for a column of an empty table.

    Rows become (column, value) pairs, a long value by its digest, and equal pairs are combined before
    the shuffle and after it.  Only distinct pairs of a map task travel, each as narrow as its value;
    Spark's own plan for several ``count(DISTINCT)`` sends every pair as a row as wide as the table."""
    types = dict(df.dtypes)
    keys = [(str(i), k) for i, c in enumerate(df.columns) if (k := _value_key(c, types[c]))]
    counts = []
    if keys:
        pairs = df.selectExpr(_stack([(i, *k) for i, k in keys], ["position", "l", "d", "s"]))
        counts.append(pairs.groupBy("position", "l", "d", "s").agg(F.lit(1)).groupBy("position").agg(F.count(F.lit(1)).alias("n_distinct")))
    others = [(str(i), c) for i, c in enumerate(df.columns) if not _value_key(c, types[c])]
    if others:
        wide = df.selectExpr(*[f"{_distinct(c)} AS d{i}" for i, c in others])
        counts.append(wide.selectExpr(_stack([(i, f"d{i}") for i, _ in others], ["position", "n_distinct"])))
    return reduce(DataFrame.unionByName, counts)


def distinct_counts(df: DataFrame, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """Long ``(column, n_distinct)``; NULL counts as one value (as ``distinct().count()``).

    Exact: all columns in one pass over (column, value) rows.  Approximate: HyperLogLog++
    sketches, one pass and no shuffle of values; :func:`distinct_sketches` keeps its states."""
    cols = df.columns
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, n_distinct bigint")
    if approx:
        wide = df.selectExpr(*[f"{_approx_distinct(c, rsd)} AS d{i}" for i, c in enumerate(cols)])
        return wide.selectExpr(_stack([(text(c), f"d{i}") for i, c in enumerate(cols)], ["column", "n_distinct"]))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "position int, column string")
    return (names.join(_exact_distinct(df), "position", "left")
            .select("column", F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct")))


#: Logarithm of the registers of a distinct sketch: 2**14 of them give a deviation of about 0.8%.
SKETCH_LG = 14


def distinct_sketches(df: DataFrame, lg: int = SKETCH_LG) -> DataFrame:
    """``(column, n_rows, n_nulls, sketch)``: one mergeable state per column, a few KB however long the table is.

    Store it per file, partition or day; :func:`union_sketches` adds states up without reading
    the rows again, and :func:`sketch_counts` gives the counts.  A value takes part by its 64-bit hash."""
    cols = df.columns
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, n_rows bigint, n_nulls bigint, sketch binary")
    types = dict(df.dtypes)
    exprs = ["count(1) AS __rows"]
    for i, c in enumerate(cols):
        # one zero and one not-a-number, as in distinct counts
        v = f"{ident(c)} + 0" if types[c] in ("float", "double") else ident(c)
        v = f"CASE WHEN isnan({v}) THEN CAST('NaN' AS {types[c]}) ELSE {v} END" if types[c] in ("float", "double") else v
        exprs += [f"{_nulls(c)} AS n{i}", f"hll_sketch_agg(CASE WHEN {ident(c)} IS NOT NULL THEN xxhash64({v}) END, {lg}) AS s{i}"]
    rows = [(text(c), "__rows", f"n{i}", f"s{i}") for i, c in enumerate(cols)]
    return df.selectExpr(*exprs).selectExpr(_stack(rows, ["column", "n_rows", "n_nulls", "sketch"]))


def union_sketches(states: DataFrame) -> DataFrame:
    """The states of several parts of a table (rows of :func:`distinct_sketches`) as those of the whole."""
    return states.groupBy("column").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
                                        F.hll_union_agg("sketch").alias("sketch"))


def sketch_counts(states: DataFrame) -> DataFrame:
    """``(column, n_rows, n_nulls, n_distinct)`` of stored states: estimates, with NULL as one value if there is one.

    A sketch that was never merged has a sharper estimate than a merged one of the same registers.
    Each is merged with itself, which changes no register, so that a whole and the union of its
    parts are estimated alike."""
    some_null = F.least("n_nulls", F.lit(1))
    merged = F.hll_union("sketch", "sketch")
    return union_sketches(states).select("column", "n_rows", "n_nulls", (F.hll_sketch_estimate(merged) + some_null).alias("n_distinct"))


#: Rows whose medians the columns are shifted by before co-moments are summed.
SHIFT_ROWS = 1000


def _moments(complete: DataFrame, k: int) -> DataFrame:
    """One row: ``n``, and sums ``s{i}`` of each ``v{i}`` and ``p{i}_{j}`` of each product (i <= j), of shifted values.

    The state of a task is one row of numbers, which the final aggregate adds up; a sum is one addition
    a row, where a streaming co-moment is four numbers and a division.  Values are shifted by medians
    of a few rows: numbers that the columns really hold, so that a constant column is 0 throughout,
    and ids or Unix times keep their precision."""
    near = complete.limit(SHIFT_ROWS).selectExpr(*[f"percentile_approx(v{i}, 0.5) AS c{i}" for i in range(k)])
    moved = with_stats(complete, near, "_c").selectExpr(*[f"v{i} - _c.c{i} AS d{i}" for i in range(k)])
    return moved.selectExpr("count(1) AS n", *[f"sum(d{i}) AS s{i}" for i in range(k)],
                            *[f"sum(d{i} * d{j}) AS p{i}_{j}" for i, j in combinations_with_replacement(range(k), 2)])


def correlation_long(df: DataFrame, cols: Sequence[str] | None = None,
                     types: Sequence[str] = CORRELATION_TYPES) -> DataFrame:
    """Pearson matrix as ``(x, y, corr)`` for every ordered pair, one aggregate pass.

    Rows with a NULL in any of the columns are left out (the matrix form needs complete
    rows); a constant column gives NULL instead of a division error.  The pass sums one vector of
    shifted co-moments (see :func:`_moments`)."""
    cols = list(cols) if cols is not None else numeric_columns(df, types)
    if not cols:
        return df.sparkSession.createDataFrame([], "x string, y string, corr double")
    k = len(cols)
    complete = df.selectExpr(*[f"CAST({ident(c)} AS DOUBLE) AS v{i}" for i, c in enumerate(cols)]).dropna()
    rows = []
    for i, j in combinations_with_replacement(range(k), 2):
        a, b, c = (f"(p{x}_{y} - s{x} * s{y} / n)" for x, y in ((i, i), (j, j), (i, j)))
        r = f"CASE WHEN {a} > 0 AND {b} > 0 THEN least(greatest({c} / (sqrt({a}) * sqrt({b})), -1D), 1D) END"
        rows.append((text(cols[i]), text(cols[j]), r))
        if i != j:
            rows.append((text(cols[j]), text(cols[i]), r))
    return _moments(complete, k).selectExpr(_stack(rows, ["x", "y", "corr"]))


def class_counts(df: DataFrame, label: str = "is_high_star") -> DataFrame:
    """Rows per class (partial + final hash aggregate)."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def profile_long(df: DataFrame, table: str, types: Sequence[str] = NUMERIC_TYPES) -> DataFrame:
    """Metadata document as a long table ``(table, column, metric, value, text)``.

    Metrics: ``type`` (in ``text``), ``nulls``, ``count`` (values that are not NULL) and
    ``distinct`` for every column, ``min``/``max``/``mean``/``stddev`` for numeric ones (in
    ``value``) and ``min``/``max`` for string ones (in ``text``).  Two aggregates, unioned: the
    plain ones in one pass (which reads only the columns it needs), the distinct counts in
    another, over (column, value) rows (see :func:`distinct_counts`)."""
    numeric, dtypes = set(numeric_columns(df, types)), dict(df.dtypes)
    plain, plain_rows = [], []
    no_value, no_text = "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)"
    for i, c in enumerate(df.columns):
        name = (text(table), text(c))
        plain += [f"CAST({_nulls(c)} AS DOUBLE) AS n{i}", f"CAST(count({ident(c)}) AS DOUBLE) AS c{i}"]
        plain_rows += [(*name, "'type'", no_value, text(dtypes[c])), (*name, "'nulls'", f"n{i}", no_text),
                       (*name, "'count'", f"c{i}", no_text)]
        if c in numeric:
            for m, fn in (("min", "min"), ("max", "max"), ("mean", "avg"), ("stddev", "stddev_samp")):
                plain.append(f"{fn}(CAST({ident(c)} AS DOUBLE)) AS {m}{i}")
                plain_rows.append((*name, f"'{m}'", f"{m}{i}", no_text))
        elif dtypes[c] == "string":
            for m in ("min", "max"):
                plain.append(f"{m}({ident(c)}) AS {m}{i}")
                plain_rows.append((*name, f"'{m}'", no_value, f"{m}{i}"))
    names = ["table", "column", "metric", "value", "text"]
    a = df.selectExpr(*plain).selectExpr(_stack(plain_rows, names))
    b = distinct_counts(df).select(F.lit(table).alias("table"), "column", F.lit("distinct").alias("metric"),
                                   F.col("n_distinct").cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
    return a.unionByName(b)
