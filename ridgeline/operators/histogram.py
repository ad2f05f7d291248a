"""Distributions (H1-H4): histograms with fixed or automatic bins, by group, density curve.

The reference pulls a whole column (or 100,000 rows) to the driver to draw it.  Here
the plotted numbers are computed in the cluster: one statistics pass (a scalar
subquery), a per-row bin number, and a grouped count.  Empty bins are emitted too,
by exploding ``sequence(0, k - 1)`` from the statistics row.

Binning is over ``k`` equal bins between the outer edges (``min``/``max``; a constant
column gets ``min - 0.5 .. max + 0.5``); a value's bin is
``least(floor((x - first) / (last - first) * k), k - 1)``, the last bin closed.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.columns import with_stats
from ridgeline.operators.ordered import exact_quantiles, finite, quantiles_from_counts


def values(df: DataFrame, c: str, by: str | None = None) -> DataFrame:
    """Finite values of ``c`` as double, column ``x`` (and ``by``): NULL, NaN and infinities are left out."""
    keep = [F.col(by)] if by else []
    return finite(df.select(*keep, F.col(c).cast("double").alias("x")))


def auto_bin_count(n: Column, lo: Column, hi: Column, q25: Column, q75: Column) -> Column:
    """NumPy's ``bins='auto'`` rule: width = min(max(Freedman-Diaconis, sqrt-rule / 2),
    Sturges), so at most about ``2 * sqrt(n)`` bins; ``ceil(range / width)`` bins, one bin
    for a zero range.  Input treated as float (no integer width floor)."""
    n = n.cast("double")
    rng = hi - lo
    sturges = rng / (F.log2(n) + F.lit(1.0))
    fd = F.lit(2.0) * (q75 - q25) * F.pow(n, F.lit(-1.0 / 3.0))
    half_sqrt = rng / F.sqrt(n) / F.lit(2.0)
    width = F.least(F.greatest(fd, half_sqrt), sturges)
    return F.when(width > 0, F.ceil(rng / width)).otherwise(F.lit(1)).cast("int")


def _stats(counts: DataFrame, bins: int | str, by: list[str], quartiles: Callable[[], DataFrame]) -> DataFrame:
    """``([by,] first, last, k)``: outer edges and bin count, from a ``([by,] x, w)`` table; ``quartiles`` gives ``q25, q75``."""
    base = counts.groupBy(*by).agg(F.sum("w").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    if bins == "auto":
        q = quartiles()
        base = base.join(q, by) if by else with_stats(base, q, "_q").select("*", "_q.q25", "_q.q75")
        k = auto_bin_count(F.col("n"), F.col("lo"), F.col("hi"), F.col("q25"), F.col("q75"))
    else:
        if int(bins) < 1:
            raise ValueError("bins must be >= 1")
        k = F.lit(int(bins))
    same = F.col("hi") == F.col("lo")
    return base.select(
        *by,
        F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("first"),
        F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("last"),
        F.when(F.col("n") > 0, k).otherwise(F.lit(0)).alias("k"),
    )


def _bin_of(x: Column) -> Column:
    first, last, k = F.col("_s.first"), F.col("_s.last"), F.col("_s.k")
    return F.least(F.floor((x - first) / (last - first) * k).cast("int"), k - 1)


def _edges(bin_col: Column) -> list[Column]:
    """Bin edges as NumPy's ``linspace``: ``first + i * step``, the last edge exactly ``last``."""
    first, last, k = F.col("_s.first"), F.col("_s.last"), F.col("_s.k")
    step = (last - first) / k
    hi = F.when(bin_col == k - 1, last).otherwise(first + (bin_col + 1) * step)
    return [(first + bin_col * step).alias("lo"), hi.alias("hi")]


def _bins() -> Column:
    some = F.sequence(F.lit(0), F.col("_s.k") - 1)
    return F.explode(F.when(F.col("_s.k") > 0, some).otherwise(F.array().cast("array<int>"))).alias("bin")


def histogram(df: DataFrame, c: str, bins: int | str = "auto", by: str | None = None, staging: str | None = None) -> DataFrame:
    """``([by,] bin, lo, hi, n)`` for every bin (empty bins have ``n = 0``).

    With ``by``, edges are shared by all groups (computed over all rows), every group gets
    every bin, and a NULL group is a group.  NULL, NaN and infinite values are in no bin.
    Rows are counted per bin where they are read, so what travels is bins, not values, and a hot
    group, value or bin is one row a task; the automatic bin count takes its quartiles by selection
    (:func:`ridgeline.operators.ordered.exact_quantiles`).  The column is scanned once for the edges, three
    times for quartiles and once for the counts: with ``staging`` it (and ``by``) is first written there
    alone, so that a costly input is computed once."""
    g = [by] if by else []
    rows = values(df, c, by)
    if staging is not None:
        rows.write.mode("overwrite").parquet(staging)
        rows = df.sparkSession.read.schema(rows.schema).parquet(staging)
    stats = _stats(rows.withColumn("w", F.lit(1)), bins, [], lambda: exact_quantiles(rows, "x", [0.25, 0.75], ["q25", "q75"]))
    found = with_stats(rows, stats).withColumn("bin", _bin_of(F.col("x"))).groupBy(*g, "bin").agg(F.count(F.lit(1)).alias("n"))
    carrier = with_stats(found.select(by).distinct(), stats) if by else stats.select(F.struct("first", "last", "k").alias("_s"))
    grid = carrier.select(*g, _bins(), "_s").select(*g, "bin", *_edges(F.col("bin")))
    found = found.select(*[F.col(k).alias(f"_{k}") for k in [*g, "bin"]], "n")
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*g, "bin"]))
    return grid.join(found, match, "left").select(*g, "bin", "lo", "hi", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


# Density curve: Gaussian KDE, Scott's bandwidth sd * n^(-1/5), evaluated on `points`
# equally spaced points over [min - cut * h, max + cut * h].
DEFAULT_POINTS = 200
#: Bandwidths beyond which ``exp(-z * z / 2)`` is 0 as a double.
UNDERFLOW = 38.7


def density(df: DataFrame, c: str, points: int = DEFAULT_POINTS, cut: float = 0.0,
            by: str | None = None, reach: float | None = None) -> DataFrame:
    """``([by,] point, x, density)`` on ``points`` grid points.

    Work is bounded by distinct values, not rows: values are counted first, everything else
    (span, size, bandwidth) follows from the counts.  Each distinct value is exploded onto the grid
    points of its band, found from its place on the grid, and summed per point before the shuffle, so
    a task sends ``points`` rows a group at most.  The band leaves out only terms that are 0 as doubles;
    ``reach`` narrows it to so many bandwidths.  A constant column (zero bandwidth) gives NULL densities.

    With ``by``, every group has its own bandwidth and normalisation (a density per
    group, as a KDE drawn per hue) and a NULL group is a group; the grid spans all groups.
    Group statistics are a grouped aggregate joined back on the group key, so the number of
    groups is not bounded by the driver.  NULL, NaN and infinite values are left out."""
    if points < 2:
        raise ValueError("points must be >= 2")
    # a NULL group gets a key of its own, so plain equi-joins keep it
    keyed = values(df, c, by).select(F.struct(*([by] if by else [F.lit(0).alias("all")])).alias("g"), "x")
    counts = keyed.groupBy("g", "x").agg(F.count(F.lit(1)).alias("w"))
    n = F.sum("w")
    mean = F.sum(F.col("w") * F.col("x")) / n
    first = counts.groupBy("g").agg(n.alias("n"), mean.alias("mean"))
    square = F.sum(F.col("w") * (F.col("x") - F.col("mean")) * (F.col("x") - F.col("mean")))
    def with_group(stats: DataFrame, *names: str) -> DataFrame:
        """The counts with figures of their group; a scalar subquery where there is one group."""
        if by:
            return counts.join(stats, "g")
        return with_stats(counts, stats.select(*names), "_p").withColumns({k: F.col(f"_p.{k}") for k in names}).drop("_p")

    per = (with_group(first, "n", "mean").groupBy("g").agg(F.max("n").alias("n"), square.alias("ss"), F.min("x").alias("lo"), F.max("x").alias("hi"))
           .withColumn("h", F.sqrt(F.try_divide(F.col("ss"), (F.col("n") - 1).cast("double"))) * F.pow(F.col("n").cast("double"), F.lit(-0.2))))
    grid = per.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("h").alias("h")).select(
        (F.col("lo") - F.lit(cut) * F.coalesce("h", F.lit(0.0))).alias("g0"),
        ((F.col("hi") - F.col("lo") + F.lit(2 * cut) * F.coalesce("h", F.lit(0.0))) / F.lit(points - 1)).alias("step"))
    at = with_stats(per.filter(F.col("n") > 0), grid).select(
        "g", "n", "h", F.col("_s.step").alias("step"), F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("_s.g0") + i * F.col("_s.step"))).alias("point", "at"))
    # a value meets the grid points of its own band: an index range, no join with the grid
    banded = with_stats(with_group(per.where("h > 0").select("g", "h"), "h"), grid)
    near = F.lit(float(UNDERFLOW if reach is None else min(reach, UNDERFLOW))) * F.col("h")

    def place(x: Column) -> Column:
        return (x - F.col("_s.g0")) / F.col("_s.step")

    low = F.greatest(F.lit(0.0), F.floor(place(F.col("x") - near)).cast("double")).cast("int")
    high = F.least(F.lit(float(points - 1)), F.ceil(place(F.col("x") + near)).cast("double")).cast("int")
    terms = (banded.where("h > 0 AND _s.step > 0").select("g", "x", "w", "h", "_s", low.alias("low"), high.alias("high"))
             .where("low <= high").select("*", F.explode(F.sequence("low", "high")).alias("point"))
             .withColumn("z", (F.col("_s.g0") + F.col("point") * F.col("_s.step") - F.col("x")) / F.col("h")))
    if reach is not None:
        terms = terms.where(F.abs("z") <= F.lit(float(reach)))
    sums = terms.groupBy("g", "point").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * F.col("z") * F.col("z"))).alias("k"))
    scaled = F.coalesce(F.col("k"), F.lit(0.0)) / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    out = at.join(sums, ["g", "point"], "left")
    return out.select(*([F.col(f"g.{by}").alias(by)] if by else []), "point", F.col("at").alias("x"),
                      F.when((F.col("h") > 0) & (F.col("step") > 0), scaled).alias("density"))


def numeric_histograms(df: DataFrame, bins: int | str = "auto",
                       types: tuple[str, ...] = ("int", "bigint", "float", "double")) -> DataFrame:
    """``(column, bin, lo, hi, n)``: a histogram of every numeric column (the profile's
    per-column distributions), each with its own edges and bin count.

    All columns share one pass: the rows are unpivoted to (column, value) and counted once,
    and every statistic is grouped by column, so the number of jobs does not grow with the
    number of columns."""
    from ridgeline.operators.clean import numeric_columns

    names = numeric_columns(df, types)
    if not names:
        return df.sparkSession.createDataFrame([], "column string, bin int, lo double, hi double, n bigint")
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names]).unpivot([], names, "column", "x")
    counts = finite(long).groupBy("column", "x").agg(F.count(F.lit(1)).alias("w"))
    stats = _stats(counts, bins, ["column"], lambda: quantiles_from_counts(counts, [0.25, 0.75], ["q25", "q75"], by=["column"])).select("column", F.struct("first", "last", "k").alias("_s"))
    found = (counts.join(stats, "column").withColumn("bin", _bin_of(F.col("x")))
             .groupBy("column", "bin").agg(F.sum("w").alias("n")))
    grid = stats.select("column", _bins(), "_s").select("column", "bin", *_edges(F.col("bin")))
    return grid.join(found, ["column", "bin"], "left").select(
        "column", "bin", "lo", "hi", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
