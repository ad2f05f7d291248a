"""Exact running sums and order statistics without a single-partition window.

A window ``ORDER BY x`` with no partition key moves every row to one task.  Instead:

1. cut the key range into contiguous ranges holding about the same number of keys: the
   edges are approximate quantiles of the key, one small aggregate inside the same plan
   (nothing runs while the plan is built), and each row finds its range by binary search.
   A skewed or heavy-tailed key distribution still gives balanced ranges;
2. total each range (partial + final aggregate, at most ``buckets`` rows per group) and
   prefix-sum those totals;
3. run the window *partitioned by range* and add the range's offset.

The result is exact whatever the edges are; the edges only balance the work.  Callers
pass a table that is already unique on the order key (e.g. per-score or per-value
counts), so a hot value is a single row here.  ``by`` keeps several sequences (one per
group) in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions.columns import with_stats

DEFAULT_BUCKETS = 1024


def range_of(edges: Column, x: Column, buckets: int) -> Column:
    """How many of the sorted ``edges`` (an array of fewer than ``buckets``) are at most ``x``."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, (buckets - 1).bit_length())))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(edges)) & (F.get(edges, at + step - 1) <= x), at + step).otherwise(at))


def _cuts(x: str, ranges: int, accuracy: int) -> Column:
    """Up to ``ranges - 1`` sorted approximate quantiles of ``x`` (the list is SQL text: one call, not one per number)."""
    return F.expr(f"array_sort(array_distinct(percentile_approx({x}, array({', '.join(f'{i / ranges!r}D' for i in range(1, ranges))}), {accuracy})))")


def running_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str], descending: bool = False,
                 buckets: int = DEFAULT_BUCKETS, prefix: str = "cum_", by: Sequence[str] = (), following: Sequence[str] = ()) -> DataFrame:
    """Add ``{prefix}{c}``: inclusive running sum of ``c`` in ``order_col`` order, within ``by``.

    ``order_col`` must be unique within ``by``, non-NULL and not NaN; infinities are ordinary
    keys.  ``by`` columns must not be NULL.  ``descending`` runs from the largest key down.
    ``following`` columns (never NULL) also get ``next_{c}``, the value in the next row: across the border
    of two ranges it is the first of the next range, carried with the range totals; NULL in the last row."""
    by = list(by)
    key = F.col(order_col).cast("double")
    keyed = df.withColumn("_ord", -key if descending else key)
    if buckets > 1:
        edges = keyed.groupBy(*by).agg(_cuts("_ord", buckets, max(10_000, 10 * buckets)).alias("e"))
        keyed = keyed.join(edges, by) if by else with_stats(keyed, edges, "_q").withColumn("e", F.col("_q.e")).drop("_q")
        keyed = keyed.withColumn("_bucket", range_of(F.col("e"), F.col("_ord"), buckets)).drop("e")
    else:
        keyed = keyed.withColumn("_bucket", F.lit(0))

    totals = keyed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols],
                                               *[F.min_by(c, "_ord").alias(f"_f_{c}") for c in following])
    ranges = Window.partitionBy(*by).orderBy("_bucket")
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.lead(f"_f_{c}").over(ranges).alias(f"_halo_{c}") for c in following],
    )
    within = Window.partitionBy(*by, "_bucket").orderBy("_ord").rowsBetween(Window.unboundedPreceding, 0)
    out = keyed.join(offsets, [*by, "_bucket"], "inner").withColumns({
        f"{prefix}{c}": F.col(f"_off_{c}") + F.sum(c).over(within) for c in sum_cols
    })
    rows = Window.partitionBy(*by, "_bucket").orderBy("_ord")
    out = out.withColumns({f"next_{c}": F.coalesce(F.lead(c).over(rows), F.col(f"_halo_{c}")) for c in following}) if following else out
    return out.drop("_bucket", "_ord", *[f"_off_{c}" for c in sum_cols], *[f"_halo_{c}" for c in following])


def value_counts(df: DataFrame, c: str) -> DataFrame:
    """``(x, w)``: count per distinct value of ``c`` as double; NULL, NaN and infinities are left out."""
    return finite(df.select(F.col(c).cast("double").alias("x"))).groupBy("x").agg(F.count(F.lit(1)).alias("w"))


def finite(df: DataFrame, c: str = "x") -> DataFrame:
    """Rows whose ``c`` (double) is a finite number."""
    return df.filter(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))


#: Ranges that the values are counted in before the ones that hold the wanted ranks are looked at.
SELECT_RANGES = 1024


def exact_quantiles(df: DataFrame, c: str, probs: Sequence[float], names: Sequence[str] | None = None,
                    ranges: int = SELECT_RANGES, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """One row of exact quantiles of ``c`` with linear interpolation between order
    statistics (position ``p * (n - 1)``; NumPy's default and SQL ``percentile_cont``).

    By selection, without a table of all values: approximate quantiles cut the values into
    ``ranges`` (one number per range travels); the rows of each are counted (again one number per
    range); only the ranges that hold a wanted rank, about one in ``ranges`` for each, are counted by
    value and ranked (see :func:`running_sums`).  The counts make the result exact whatever the cuts
    are.  The column is scanned three times: stage a costly one first.  No value at all gives NULLs."""
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    if ranges < 2:
        raise ValueError("ranges must be >= 2")
    rows = finite(df.select(F.col(c).cast("double").alias("x")))
    edges = rows.agg(_cuts("x", ranges, max(10_000, 4 * ranges)).alias("e"))
    cut = with_stats(rows, edges).select("x", range_of(F.col("_s.e"), F.col("x"), ranges).alias("r"))
    # at most one row a range: a window in one task
    order = Window.orderBy("r")
    totals = cut.groupBy("r").agg(F.count(F.lit(1)).alias("w")).select(
        "r", "w", (F.sum("w").over(order) - F.col("w")).alias("before"), F.sum("w").over(Window.partitionBy()).alias("n"))
    positions = [F.lit(float(p)) * (F.col("n") - 1).cast("double") for p in probs]
    ranks = [f(pos) for pos in positions for f in (F.floor, F.ceil)]
    holds = F.array_sort(F.array_distinct(F.array(*[r.cast("bigint") for r in ranks])))
    kept = totals.where(F.exists(holds, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("w")))).agg(
        F.map_from_entries(F.collect_list(F.struct("r", "before"))).alias("before"), F.max("n").alias("n"))
    inside = with_stats(cut, kept, "_k").where("map_contains_key(_k.before, r)")
    counts = inside.groupBy("r", "x").agg(F.count(F.lit(1)).alias("w"))
    ranked = with_stats(running_sums(counts, "x", ["w"], buckets=buckets, by=["r"]), kept, "_k").select(
        "x", F.col("_k.n").alias("n"), (F.col("_k.before")[F.col("r")] + F.col("cum_w")).alias("end"), "w")

    def at_rank(r):
        return F.max(F.when((F.col("end") - F.col("w") <= r) & (r < F.col("end")), F.col("x")))

    aggs = []
    for i, pos in enumerate(positions):
        aggs += [at_rank(F.floor(pos)).alias(f"_lo{i}"), at_rank(F.ceil(pos)).alias(f"_hi{i}"), F.max(pos - F.floor(pos)).alias(f"_f{i}")]
    return ranked.agg(*aggs).select(*[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(names[i]) for i in range(len(probs))])


def quantiles_from_counts(counts: DataFrame, probs: Sequence[float], names: Sequence[str] | None = None,
                          buckets: int = DEFAULT_BUCKETS, by: Sequence[str] = ()) -> DataFrame:
    """:func:`exact_quantiles` of a ``([by,] x, w)`` value-count table, of which all values are ranked: one row (per group)."""
    by = list(by)
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    ranked = running_sums(counts, "x", ["w"], buckets=buckets, by=by).withColumn("_start", F.col("cum_w") - F.col("w"))
    n = counts.groupBy(*by).agg(F.sum("w").alias("n"))
    joined = ranked.join(n, by) if by else with_stats(ranked, n).withColumn("n", F.col("_s.n")).drop("_s")

    def at_rank(r):
        return F.max(F.when((F.col("_start") <= r) & (r < F.col("cum_w")), F.col("x")))

    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1).cast("double")
        aggs += [at_rank(F.floor(pos)).alias(f"_lo{i}"), at_rank(F.ceil(pos)).alias(f"_hi{i}"),
                 F.max(pos - F.floor(pos)).alias(f"_f{i}")]
    picked = joined.groupBy(*by).agg(*aggs)
    return picked.select(*by, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(names[i])
        for i in range(len(probs))
    ])
