"""Cleaning (C3-C14): names, sparse columns, validity rules, null rows, policies, summary.

The three reference cleaning scripts are three policies over one operator set:

* ``"sparse20"`` (A): drop columns with null fraction > 0.20, then drop rows with any null
* ``"validated"`` (B, default): drop columns > 0.05, validity filter, then drop null rows
* ``"rename"`` (C): spaces -> underscores in names, drop listed columns, drop null rows

Only the sparse-column step reads data eagerly: the output *schema* depends on the
null counts, so one aggregate row (all columns, one pass) is collected at plan time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Fixed values from the reference validity filter: closed ranges, then columns that
# must be non-negative.  A rule applies only when its column is present.
RANGE_RULES = (
    ("stars", 1, 5),
    ("latitude", -90, 90),
    ("longitude", -180, 180),
)
NON_NEGATIVE_COLUMNS = (
    "review_count", "cool", "funny", "useful", "compliment_cool", "compliment_cute",
    "compliment_funny", "compliment_hot", "compliment_list", "compliment_more",
    "compliment_note", "compliment_photos", "compliment_plain", "compliment_profile",
    "compliment_writer", "fans",
)

POLICIES = {
    "sparse20": {"max_null_frac": 0.20, "validate": False, "rename": False},
    "validated": {"max_null_frac": 0.05, "validate": True, "rename": False},
    "rename": {"max_null_frac": None, "validate": False, "rename": True},
}
DEFAULT_POLICY = "validated"


def normalise_names(df: DataFrame) -> DataFrame:
    """Spaces -> underscores in every column name, in one projection."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    names = [n for n in names if n in df.columns]
    return df.drop(*names) if names else df


def numeric_columns(df: DataFrame, types: Sequence[str] = ("int", "bigint", "float", "double")) -> list[str]:
    """Columns whose simple type name is in ``types`` (plan-time, from the schema)."""
    return [c for c, t in df.dtypes if t in types]


def null_count_row(df: DataFrame) -> DataFrame:
    """One row: ``__rows`` plus the NULL count of every column (0 on an empty table).

    Written as SQL text for one ``selectExpr`` call however wide the table is."""
    def q(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"

    return df.selectExpr(
        "count(1) AS __rows",
        *[f"CAST(coalesce(sum(CAST(isnull({q(c)}) AS INT)), 0) AS BIGINT) AS {q(c)}" for c in df.columns],
    )


def sparse_columns(df: DataFrame, max_null_frac: float, null_row: dict | None = None) -> list[str]:
    """Columns whose NULL fraction over all rows is strictly above ``max_null_frac``.

    One aggregate pass, one collected row (or a row already read with
    :func:`null_count_row`).  An empty table drops nothing."""
    row = dict(null_row) if null_row is not None else null_count_row(df).first().asDict()
    n = row.pop("__rows")
    if not n:
        return []
    return [c for c in df.columns if row[c] / n > max_null_frac]


def drop_sparse_columns(df: DataFrame, max_null_frac: float = 0.05) -> DataFrame:
    return drop_columns(df, sparse_columns(df, max_null_frac))


def validity_predicates(df: DataFrame) -> list[Column]:
    preds = []
    for c, lo, hi in RANGE_RULES:
        if c in df.columns:
            preds.append((F.col(c) >= F.lit(lo)) & (F.col(c) <= F.lit(hi)))
    for c in NON_NEGATIVE_COLUMNS:
        if c in df.columns:
            preds.append(F.col(c) >= F.lit(0))
    return preds


def validity_filter(df: DataFrame) -> DataFrame:
    """Keep rows passing every applicable rule (3-valued: NULL in a checked column drops)."""
    preds = validity_predicates(df)
    if not preds:
        return df
    return df.filter(reduce(lambda a, b: a & b, preds))


def _not_null(df: DataFrame, subset: Sequence[str] | None = None) -> Column | None:
    """Predicate equal to ``dropna(how='any')``: NULL, and NaN in float/double, fail."""
    cols = list(subset) if subset is not None else df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    preds = []
    for c in cols:
        ref = F.col(f"`{c}`")
        p = ref.isNotNull()
        if isinstance(types[c], (DoubleType, FloatType)):
            p = p & ~F.isnan(ref)
        preds.append(p)
    return reduce(lambda a, b: a & b, preds) if preds else None


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of ``subset`` (default: all columns)."""
    return df.dropna(how="any", subset=list(subset) if subset is not None else None)


def _plan(df: DataFrame, policy: str, drop: Sequence[str] = (),
          null_row: dict | None = None) -> tuple[DataFrame, list[str], Column | None]:
    """Column-level part of a policy: (frame after column steps, dropped names, row predicate)."""
    spec = POLICIES[policy]
    dropped: list[str] = []
    if spec["rename"]:
        df = normalise_names(df)
    if spec["max_null_frac"] is not None:
        dropped = sparse_columns(df, spec["max_null_frac"], null_row)
    dropped += [c for c in drop if c in df.columns and c not in dropped]
    df = drop_columns(df, dropped)
    preds = validity_predicates(df) if spec["validate"] else []
    nn = _not_null(df)
    if nn is not None:
        preds.append(nn)
    keep = reduce(lambda a, b: a & b, preds) if preds else None
    return df, dropped, keep


def clean(df: DataFrame, policy: str = DEFAULT_POLICY, drop: Sequence[str] = (), null_row: dict | None = None) -> DataFrame:
    """Apply a cleaning policy (order kept: sparse columns, validity, null rows).

    ``null_row``: the table's :func:`null_count_row`, if it is known already."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; choose from {sorted(POLICIES)}")
    out, _, _ = _plan(df, policy, drop, null_row)
    spec = POLICIES[policy]
    if spec["validate"]:
        out = validity_filter(out)
    return drop_null_rows(out)


def clean_summary(df: DataFrame, policy: str = DEFAULT_POLICY, drop: Sequence[str] = ()) -> DataFrame:
    """One row: rows / columns before and after, dropped counts and dropped names.

    Rows before and after come from one aggregate: the kept-row predicate is counted
    with ``count_if`` instead of running the cleaned plan a second time."""
    return clean_summaries(df, [policy], drop)


def clean_summaries(df: DataFrame, policies: Sequence[str] = tuple(POLICIES),
                    drop: Sequence[str] = ()) -> DataFrame:
    """:func:`clean_summary` for several policies in two passes over ``df``: one null-count
    row shared by every policy's sparse-column rule, then one aggregate holding a
    ``count_if`` of each policy's kept-row predicate."""
    for p in policies:
        if p not in POLICIES:
            raise ValueError(f"unknown policy {p!r}; choose from {sorted(POLICIES)}")
    needs_nulls = any(POLICIES[p]["max_null_frac"] is not None for p in policies)
    null_row = null_count_row(df).first().asDict() if needs_nulls else None
    cols_before = len(df.columns)
    renamed = normalise_names(df)
    aggs, meta = [F.count(F.lit(1)).alias("rows_before")], []
    for i, p in enumerate(policies):
        # a renamed policy's predicate is written on the renamed frame; renaming keeps
        # column positions, so it is mapped back onto the original names
        base = renamed if POLICIES[p]["rename"] else df
        row = null_row
        if row is not None and POLICIES[p]["rename"]:
            row = {"__rows": null_row["__rows"], **{r: null_row[c] for c, r in zip(df.columns, renamed.columns)}}
        out, dropped, keep = _plan(base, p, drop, row)
        if POLICIES[p]["rename"] and keep is not None:
            keep = _not_null(df.drop(*[c for c, r in zip(df.columns, renamed.columns) if r in dropped]))
        aggs.append((F.count_if(keep) if keep is not None else F.count(F.lit(1))).alias(f"kept{i}"))
        meta.append((p, len(out.columns), dropped))
    stats = df.agg(*aggs)
    parts = []
    for i, (p, cols_after, dropped) in enumerate(meta):
        parts.append(stats.select(
            F.lit(p).alias("policy"),
            F.col("rows_before"),
            F.col(f"kept{i}").alias("rows_after"),
            (F.col("rows_before") - F.col(f"kept{i}")).alias("rows_dropped"),
            F.lit(cols_before).alias("columns_before"),
            F.lit(cols_after).alias("columns_after"),
            F.lit(len(dropped)).alias("columns_dropped"),
            F.lit(",".join(sorted(dropped))).alias("dropped_columns"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
