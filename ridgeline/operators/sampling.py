"""Limits, sampling and splitting (L2-L7).

Random steps that must be checkable or must survive a task retry use a stable hash of
the row key (:func:`ridgeline.functions.columns.hash_unit`): the assignment of a row
does not depend on partitioning, task order or executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions.columns import hash_unit, with_stats

# Samples and folds draw independently of the split.
SAMPLE_SALT, FOLD_SALT = ":sample", ":fold"

#: Ranges of equal width that the 32-bit hashes are counted in to find the n smallest.
HASH_RANGES = 1 << 16


def limit_rows(df: DataFrame, n: int, order_by: str | Sequence[str]) -> DataFrame:
    """First ``n`` rows by a key (a bounded top-n, not a full sort)."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)


def first_values(df: DataFrame, c: str, n: int = 10) -> DataFrame:
    """The ``n`` smallest non-NULL values of ``c`` (the reference's 10-value peek)."""
    return df.select(c).dropna().orderBy(c).limit(n)


def sample_rows(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_fraction(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Stable sample of about ``fraction`` of the rows by a hash of ``key``, which every row states in
    ``sample_fraction``.  The choice to sample is always the caller's: nothing samples by input size."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    share = F.lit(float(fraction))
    return df.filter(hash_unit(key, 1_000_000, SAMPLE_SALT) < F.lit(int(round(fraction * 1_000_000)))).withColumn("sample_fraction", share)


def sample_exact(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): those with the smallest hashes of ``key``, ties by ``key``.

    By selection: the rows of each range of hashes are counted (one number a range travels), the ranges below the
    one that holds the ``n``-th row are taken whole where they are read, and only the rows of that one, about one
    in ``HASH_RANGES``, are sorted (more, if its key repeats that often).  ``df`` is scanned three times and must give the same rows each time.
    The same rows whatever the partitioning and however often a task runs."""
    if n < 0:
        raise ValueError("n must not be negative")
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(SAMPLE_SALT)))
    hashed = df.withColumn("_hash", F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"))
    # rows without a key come first, as in a sort
    ranged = hashed.withColumn("_range", F.coalesce(F.floor(F.col("_hash") / (2**32 // HASH_RANGES)), F.lit(-1)))
    # a row a range: a window in one task
    ends = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("w")).select("_range", F.sum("w").over(Window.orderBy("_range")).alias("end"))
    cut = ends.agg(F.coalesce(F.min(F.when(F.col("end") > n, F.col("_range"))), F.lit(HASH_RANGES)).alias("border"),
                   F.coalesce(F.max(F.when(F.col("end") <= n, F.col("end"))), F.lit(0)).alias("before"))
    found = with_stats(ranged, cut, "_cut")
    rank = F.row_number().over(Window.orderBy("_hash", key))
    border = found.where(F.col("_range") == F.col("_cut.border")).withColumn("_rank", rank).where(F.col("_rank") + F.col("_cut.before") <= n)
    return found.where(F.col("_range") < F.col("_cut.border")).select(*df.columns).unionAll(border.select(*df.columns))


def sample_bytes(df: DataFrame, path: str, key: str, cap: int) -> DataFrame:
    """Rows of ``df`` for about ``cap`` bytes of the input it is read from, whose size is measured at ``path``.

    An input within the cap is returned whole.  Beyond it the rows are ``ceil(rows * cap / size)``, exactly."""
    from ridgeline.sources.io import input_bytes

    size = input_bytes(df.sparkSession, path).first().input_bytes
    if size <= cap:
        return df
    return sample_exact(df, key, -(-df.count() * cap // size))


def fraction_for_bytes(total: int, cap: int) -> float:
    """The fraction that brings ``total`` input bytes to about ``cap`` (1 at or below it)."""
    return 1.0 if total <= cap else cap / total


def split_random(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` as the reference does (depends on the input partitioning)."""
    return df.randomSplit(list(weights), seed=seed)


def split_hash(df: DataFrame, key: str, train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Stable split: a row is in train when ``hash(key) % 100 < train_pct``."""
    h = hash_unit(key, 100)
    return df.filter(h < train_pct), df.filter(h >= train_pct)


def split_label(key: str, train_pct: int = 80):
    """The split name of a row as a column (``train`` / ``test``)."""
    return F.when(hash_unit(key, 100) < train_pct, F.lit("train")).otherwise(F.lit("test"))


def fold_of(df: DataFrame, key: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Stable k-fold assignment ``0..k-1`` (usable as ``CrossValidator(foldCol=...)``), independent of the split."""
    return df.withColumn(out, hash_unit(key, k, FOLD_SALT))
