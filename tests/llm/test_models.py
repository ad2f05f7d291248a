"""Classifiers: held-out accuracy and odd rows."""

import random

import numpy as np
import pytest
from helpers import SCHEMA, frame
from pyspark.sql import functions as F

from ridgeline.llm.language import fit_language, predict_language, with_language
from ridgeline.llm.quality import fit_quality, score_quality
from ridgeline.llm.queries import QUERIES
from ridgeline.llm.svm import Rows, hinge_svm, platt, sigmoid

SF = "/root/testdata/sf0.1"


def test_dual_coordinate_descent():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    y = np.where(x @ [1, -2, 0.5, 0, 1] + 0.3 > 0, 1.0, -1.0)
    rows = Rows(np.arange(0, 1001, 5), np.tile(np.arange(5), 200), x.reshape(-1))
    cost = np.full(200, 1.0)
    w = hinge_svm(rows, y, 5, cost, epochs=300)

    def primal(w):
        return w @ w / 2 + np.maximum(0, 1 - y * (x @ w[:5] + w[5])).sum()

    for _ in range(300):  # no small step improves it
        assert primal(w) <= primal(w + rng.normal(size=6) * 0.01) + 1e-3
    margin = x @ w[:5] + w[5]
    a, b = platt(margin, y, np.ones(200))
    assert ((sigmoid(a * margin + b) > 0.5) == (y > 0)).mean() > 0.97


def test_quality_held_out(spark):
    out = QUERIES["op6_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = out.where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    up, down = (np.array([r.score for r in rows if r.quality == q]) for q in (1, 0))
    assert (up[:, None] > down[None, :]).mean() > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op10_language_id"](spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    use = F.pmod(F.col("doc_id"), F.lit(5)) != 0
    changed = docs.withColumn("lang", F.when(use, F.col("lang")).otherwise("xx"))
    assert fit_language(docs, use) == fit_language(changed, use)


def test_many_languages(spark):
    rng = random.Random(1)
    words = {"en": "the and of house", "de": "der und von haus", "fr": "le et de maison", "es": "el y de casa", "it": "il e di casina", "zz": "qo xo zo"}
    texts = [" ".join(rng.choices(w.split(), k=rng.randrange(2, 30))) for w in words.values() for _ in range(60)]
    langs = [k for k in words for _ in range(60)]
    docs = frame(spark, texts, langs=langs)
    rows = predict_language(docs, fit_language(docs)).collect()
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows]) > 0.97


def test_odd_language_rows(spark):
    docs = frame(spark, ["the house", "das haus", "the end", "der mann"] * 5, langs=["en", "de"] * 10)
    model = fit_language(docs)
    odd = frame(spark, [None, "", "12 !? \n", "🙂", "é", "the", "the", "ж" * 9999], ids=[None, 1, 2, 3, 4, 5, 5, 7])
    out = predict_language(odd, model).collect()
    assert len(out) == 8 and sorted(r.doc_id or 0 for r in out if r.lang_pred == "und") == [0, 1, 2, 3]
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    assert len({(r.lang_pred, r.score) for r in out if r.doc_id == 5}) == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert predict_language(empty, model).count() == 0
    none = predict_language(odd, fit_language(empty)).collect()
    assert {r.lang_pred for r in none} == {"und"}
    one = fit_language(frame(spark, ["a b"], langs=["en"]))
    assert {r.lang_pred for r in predict_language(odd, one).collect()} == {"und", "en"}
    assert with_language(odd, model).columns == [*odd.columns, "lang_pred", "lang_score"]


def test_odd_quality_rows(spark):
    good, bad = ["Some words, that are fine."] * 12, ["BUY!! NOW!! NOW!!"] * 12
    docs = frame(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 12)) for i in range(24)] + [(None, 1), (3, None), (999, 0)], "doc_id long, label int")
    model = fit_quality(docs, labels)
    odd = frame(spark, [None, "", "fine words, that are fine.", "BUY!! NOW!!", "x", "x", "Ü" * 9999], ids=[None, 1, 2, 3, 4, 4, 5])
    out = score_quality(odd, model).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    scores = {r.doc_id: r.score for r in out}
    assert scores[2] > 0.7 > scores[3]
    assert score_quality(spark.createDataFrame([], SCHEMA), model).count() == 0
    nothing = fit_quality(docs, labels.where("false"))
    assert {r.score for r in score_quality(odd, nothing).collect()} == {0.5}
    one = fit_quality(docs, labels.where("label = 1"))
    assert {r.score for r in score_quality(odd, one).collect()} == {1.0}
    assert pytest.approx(1.0) == max(r.score for r in score_quality(odd, one).collect())
