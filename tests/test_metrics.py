import itertools

import numpy as np

from support import SF_MID, SF_SMALL
from ridgeline.operators import metrics as M
from ridgeline.sources import fixtures as fx


def _brute_auc(labels, scores):
    pos = [s for l, s in zip(labels, scores) if l == 1]
    neg = [s for l, s in zip(labels, scores) if l == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_confusion_and_prf_fixture(spark):
    s = fx.scored(spark, SF_MID)
    c = M.confusion_counts(s).first()
    assert (c.tp, c.fp, c.tn, c.fn) == (2398, 2321, 3822, 1459)
    p = M.precision_recall_f1(s).first()
    assert abs(p.precision - 2398 / (2398 + 2321)) < 1e-12
    assert abs(p.recall - 2398 / (2398 + 1459)) < 1e-12


def test_prf_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    p = M.precision_recall_f1(df).first()
    assert (p.precision, p.recall, p.f1) == (0.0, 0.0, 0.0)


def test_auc_exact_fixture(spark):
    assert round(M.auc_exact(fx.scored(spark, SF_SMALL)).first().auc, 6) == 0.712189
    assert round(M.auc_exact(fx.scored(spark, SF_MID)).first().auc, 6) == 0.714771


def test_auc_exact_ties_brute_force(spark):
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, 400).tolist()
    scores = np.round(rng.random(400), 1).tolist()  # heavy ties
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    got = M.auc_exact(df).first().auc
    assert abs(got - _brute_auc(labels, scores)) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.7)], "label int, score double")
    assert M.auc_exact(df).first().auc is None


def test_roc_points_monotone_and_complete(spark):
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 2, 300).tolist()
    scores = np.round(rng.random(300), 2).tolist()
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    pts = M.roc_points(df).collect()
    origin = [p for p in pts if p.threshold is None]
    assert len(origin) == 1 and (origin[0].fpr, origin[0].tpr) == (0.0, 0.0)
    curve = sorted((p for p in pts if p.threshold is not None), key=lambda p: -p.threshold)
    assert len(curve) == len(set(scores))
    assert abs(curve[-1].fpr - 1.0) < 1e-12 and abs(curve[-1].tpr - 1.0) < 1e-12
    for a, b in zip(curve, curve[1:]):
        assert a.fpr <= b.fpr and a.tpr <= b.tpr
    # trapezoid area over the curve equals the exact AUC
    xs = [0.0] + [p.fpr for p in curve]
    ys = [0.0] + [p.tpr for p in curve]
    area = sum((x2 - x1) * (y1 + y2) / 2 for x1, x2, y1, y2 in zip(xs, xs[1:], ys, ys[1:]))
    assert abs(area - _brute_auc(labels, scores)) < 1e-9


def test_confusion_matrix_zero_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, prediction int")
    got = {(r.label, r.prediction): r.n for r in M.confusion_matrix(df).collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}


def test_metrics_table(spark):
    t = {r.metric: r.value for r in M.metrics_table(fx.scored(spark, SF_SMALL)).collect()}
    assert set(t) == {"roc_auc", "precision", "recall", "f1"}
    assert round(t["roc_auc"], 6) == 0.712189


def test_single_score_and_empty_input(spark):
    one = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5)], "label int, score double")
    assert M.auc_exact(one).first().auc == 0.5
    pts = [p for p in M.roc_points(one).collect() if p.threshold is not None]
    assert len(pts) == 1 and (pts[0].fpr, pts[0].tpr) == (1.0, 1.0)
    empty = spark.createDataFrame([], "label int, score double")
    assert M.auc_exact(empty).first().auc is None
    assert M.roc_points(empty).count() == 0


def test_roc_without_collinear_points(spark):
    import random

    import numpy as np

    from ridgeline.operators.metrics import roc_points
    rng = random.Random(2)
    for n, k in ((400, 1000), (400, 12), (1, 5), (60, 60)):
        rows = [(rng.randrange(k) / 8, int(rng.random() < 0.7)) for _ in range(n)]
        scores = sorted({s for s, _ in rows}, reverse=True)
        pos = np.array([sum(y for s, y in rows if s == t) for t in scores])
        neg = np.array([sum(1 - y for s, y in rows if s == t) for t in scores])
        tps, fps = np.cumsum(pos), np.cumsum(neg)
        keep = np.ones(len(scores), bool)
        if len(scores) > 2:
            keep[1:-1] = (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0)
        df = spark.createDataFrame(rows, "score double, label int")
        for buckets in (3, 64):
            got = roc_points(df, drop_collinear=True, buckets=buckets).where("threshold IS NOT NULL").orderBy("threshold", ascending=False).collect()
            assert [r.threshold for r in got] == [s for s, y in zip(scores, keep) if y]
            want = tps[keep] / tps[-1] if tps[-1] else [None] * keep.sum()
            assert [r.tpr for r in got] == list(want)
        assert roc_points(df).count() == len(scores) + 1


def test_roc_without_collinear_points_of_an_empty_table(spark):
    from ridgeline.operators.metrics import roc_points
    assert roc_points(spark.createDataFrame([], "score double, label int"), drop_collinear=True).collect() == []


def test_auc_from_staged_counts(spark, tmp_path):
    from ridgeline.operators.metrics import auc_by
    # group 2 has no negative, a score and a label are NULL, scores are tied
    rows = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.9), (1, 0, 0.1), (1, 1, None), (1, None, 0.4), (1, 1, 0.9), (2, 1, 0.3)], "g int, label int, score double")
    folder = str(tmp_path / "counts")
    got = auc_by(rows, ["g"], staging=folder)
    assert all(f"{folder}/" in f for f in got.inputFiles()) and got.inputFiles()  # no row is read again
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, auc_by(rows, ["g"]).collect())) == [(1, 0.75), (2, None)]
    assert sorted(map(tuple, spark.read.parquet(folder).collect())) == [(1, 0.1, 0, 1), (1, 0.9, 2, 1), (2, 0.3, 1, 0)]
