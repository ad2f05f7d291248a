"""Evaluation (P11-P16, S10): confusion counts, precision / recall / F1, exact AUC, ROC,
confusion matrix, metrics report.

All are cluster aggregates.  The reference runs four filtered counts over uncached
predictions and pulls every prediction to pandas for the ROC / AUC / matrix; here the
counts are one ``count_if`` aggregate and the curve is computed from per-score counts
with exact running sums (:mod:`ridgeline.operators.ordered`), never a global sort of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.columns import with_stats
from ridgeline.operators.ordered import DEFAULT_BUCKETS, running_sums
from ridgeline.sources.io import write_parquet


def _confusion_aggs(label: str, pred: str) -> list[Column]:
    l, p = F.col(label), F.col(pred)
    return [
        F.count_if((l == 1) & (p == 1)).alias("tp"),
        F.count_if((l == 0) & (p == 1)).alias("fp"),
        F.count_if((l == 0) & (p == 0)).alias("tn"),
        F.count_if((l == 1) & (p == 0)).alias("fn"),
    ]


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row ``(tp, fp, tn, fn)`` from a single aggregate."""
    return df.agg(*_confusion_aggs(label, pred))


def _prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    precision = ratio(tp, tp + fp)
    recall = ratio(tp, tp + fn)
    f1 = ratio(F.lit(2.0) * precision * recall, precision + recall)
    return [precision.alias("precision"), recall.alias("recall"), f1.alias("f1")]


def precision_recall_f1(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row ``(precision, recall, f1)``; 0 where a denominator is 0."""
    c = confusion_counts(df, label, pred)
    return c.select(*_prf(F.col("tp"), F.col("fp"), F.col("fn")))


def score_counts(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """``([by,] s, pos, neg)`` per distinct score: the only input the ROC / AUC need.

    A hot score (many tied rows) becomes one row after map-side combine."""
    s = F.col(score).cast("double")
    rows = df.select(*by, s.alias("s"), F.col(label).alias("_y")).filter(
        F.col("s").isNotNull() & ~F.isnan("s") & F.col("_y").isNotNull()
    )
    return rows.groupBy(*by, "s").agg(
        F.count_if(F.col("_y") == 1).alias("pos"),
        F.count_if(F.col("_y") == 0).alias("neg"),
    )


def auc_by(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score", staging: str | None = None) -> DataFrame:
    """``([by,] auc)``: exact ROC area of every group, ties counted one half (Mann-Whitney).

    ``2 * P * N * auc = sum over scores of neg * (2 * positives above + pos)``; the sum
    is carried as decimal(38,0), so it is exact and independent of summation order.
    NULL when a class is absent.  ``by`` columns must not be NULL; without any there is one row.

    The running sums read the counts three times, for which the rows of ``df`` are read and shuffled each time;
    with ``staging`` the counts are written there once and read back."""
    counts = score_counts(df, label, score, by)
    if staging is not None:
        write_parquet(counts, staging)
        counts = counts.sparkSession.read.schema(counts.schema).parquet(staging)
    per = running_sums(counts, "s", ["pos"], descending=True, by=by)
    above = F.col("cum_pos") - F.col("pos")
    term = F.col("neg").cast("decimal(38,0)") * (F.lit(2) * above + F.col("pos")).cast("decimal(38,0)")
    agg = per.groupBy(*by).agg(
        F.sum(term).alias("num"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    den = F.lit(2.0) * F.col("p").cast("double") * F.col("n").cast("double")
    return agg.select(*by, F.try_divide(F.col("num").cast("double"), den).alias("auc"))


def auc_exact(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row ``(auc)``: :func:`auc_by` over all rows."""
    return auc_by(df, (), label, score)


def roc_points(df: DataFrame, label: str = "label", score: str = "score", drop_collinear: bool = False,
               buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """``(threshold, fpr, tpr)``: one point per distinct score (predict 1 when
    ``score >= threshold``), plus the origin with a NULL threshold.

    ``drop_collinear`` leaves out points in the middle of a straight, evenly stepped stretch, which change
    neither a drawn curve nor its area: those after which as many positives and negatives are
    added as with them.  The first and the last score stay."""
    counts = score_counts(df, label, score)
    per = running_sums(counts, "s", ["pos", "neg"], descending=True, buckets=buckets, following=["pos", "neg"] if drop_collinear else [])
    if drop_collinear:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        turns = ~(F.col("next_pos").eqNullSafe(F.col("pos")) & F.col("next_neg").eqNullSafe(F.col("neg")))
        per = per.where(first | turns)
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = with_stats(per, totals).select(
        F.col("s").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("_s.n").cast("double")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("_s.p").cast("double")).alias("tpr"),
    )
    origin = totals.filter((F.col("p") + F.col("n")) > 0).select(
        F.lit(None).cast("double").alias("threshold"),
        F.when(F.col("n") > 0, F.lit(0.0)).alias("fpr"),
        F.when(F.col("p") > 0, F.lit(0.0)).alias("tpr"),
    )
    return origin.unionByName(points)


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Long ``(label, prediction, n)``: every cell of ``classes x classes`` (zero cells
    included) plus any other observed cell.  ``classes`` is the fixed binary class list."""
    spark = df.sparkSession
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).cast("int").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))
    cells = spark.createDataFrame([(a, b) for a in classes for b in classes], "label int, prediction int")
    out = cells.join(counts, ["label", "prediction"], "full_outer")
    return out.select("label", "prediction", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


def metrics_table(df: DataFrame, label: str = "label", pred: str = "prediction",
                  score: str = "score") -> DataFrame:
    """Report as ``(metric, value)``: roc_auc, precision, recall, f1."""
    counts = df.agg(*_confusion_aggs(label, pred))
    auc = auc_exact(df, label, score)
    wide = with_stats(counts, auc, "_a").select(
        F.col("_a.auc").alias("roc_auc"), *_prf(F.col("tp"), F.col("fp"), F.col("fn")),
    )
    return wide.unpivot([], ["roc_auc", "precision", "recall", "f1"], "metric", "value")


prf = precision_recall_f1
