import pytest

from support import SF_MID
from ridgeline.plans import features as FE
from ridgeline.plans import model as MO
from ridgeline.session import scratch_path
from ridgeline.sources import fixtures as fx


@pytest.fixture(scope="module")
def fitted(spark):
    f = FE.build_features(fx.review_signal(spark, SF_MID), fx.business(spark, SF_MID), fx.users(spark, SF_MID),
                          staging=scratch_path(spark, "signal"))
    train, test = MO.split_train_test(f)
    model = MO.cross_validate(train, folds=2, reg=(0.01, 0.1), enet=(0.0,))
    return f, model, test


def test_cv_metrics_rows(fitted):
    _, model, _ = fitted
    m = MO.cv_metrics(model).collect()
    assert len(m) == 2 and all(0.0 <= r.avg_auc <= 1.0 for r in m)


def test_auc_ml_close_to_exact(fitted):
    from ridgeline.operators.metrics import auc_exact
    _, model, test = fitted
    pred = MO.flatten_predictions(model.bestModel.transform(test)).cache()
    exact = auc_exact(pred, "label", "probability_1").first().auc
    ml = MO.auc_ml(model.bestModel.transform(test))
    assert abs(exact - ml) < 1e-3


def test_model_roundtrip_equal_predictions(spark, fitted):
    _, model, test = fitted
    path = scratch_path(spark, "model")
    MO.save_model(model.bestModel, path)
    loaded = MO.load_model(path)
    a = {r.review_id: r.probability_1 for r in MO.flatten_predictions(model.bestModel.transform(test)).collect()}
    b = {r.review_id: r.probability_1 for r in MO.flatten_predictions(loaded.transform(test)).collect()}
    assert a == b


def test_feature_importance_sorted(fitted):
    _, model, _ = fitted
    rows = MO.feature_importance(model.bestModel).collect()
    assert [r.feature for r in rows] and set(r.feature for r in rows) == set(MO.FEATURE_COLUMNS)
    assert rows[0].abs_coefficient >= rows[-1].abs_coefficient > 0.1


def test_minmax_matches_ml_scaler(spark, fitted):
    from pyspark.ml.feature import MinMaxScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    f, _, _ = fitted
    cols = list(MO.FEATURE_COLUMNS)
    ours = {r.review_id: (r[f"scaled_{cols[0]}"], r[f"scaled_{cols[1]}"])
            for r in MO.minmax_scale(f, cols).collect()}
    va = VectorAssembler(inputCols=cols, outputCol="v").transform(f)
    sc = MinMaxScaler(inputCol="v", outputCol="s").fit(va).transform(va)
    ml = {r.review_id: tuple(r.a) for r in sc.select("review_id", vector_to_array("s").alias("a")).collect()}
    for k, v in ours.items():
        assert abs(v[0] - ml[k][0]) < 1e-12 and abs(v[1] - ml[k][1]) < 1e-12


def test_constant_column_minmax_half(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r.scaled_x for r in MO.minmax_scale(df, ["x"]).collect()] == [0.5, 0.5]


def test_evaluation_report(fitted):
    _, model, test = fitted
    rep = {r.metric: r.value for r in MO.evaluation_report(model.bestModel.transform(test)).collect()}
    assert set(rep) == {"roc_auc", "roc_auc_exact", "precision", "recall", "f1"}
    assert abs(rep["roc_auc"] - rep["roc_auc_exact"]) < 1e-3
    assert 0.0 <= rep["f1"] <= 1.0


def test_fold_aucs_equal_sql_over_the_written_scores(spark, duck, tmp_path):
    f = FE.build_features(fx.review_signal(spark, SF_MID), fx.business(spark, SF_MID), fx.users(spark, SF_MID), staging=scratch_path(spark, "signal"))
    train, _ = MO.split_train_test(f)
    path = str(tmp_path / "scores")
    model = MO.cross_validate(train, folds=3, reg=(0.01, 0.5), enet=(0.0, 1.0), scores_path=path)
    con = duck(SF_MID)
    want = con.execute(f"""
        WITH s AS (SELECT * FROM read_parquet('{path}/*.parquet')),
        ranked AS (SELECT *, (rank() OVER w + rank() OVER w + count(*) OVER (PARTITION BY setting, fold, margin) - 1) / 2.0 AS r
                   FROM s WINDOW w AS (PARTITION BY setting, fold ORDER BY margin))
        SELECT setting, fold, (sum(r) FILTER (label = 1) - p * (p + 1) / 2.0) / (p * q) AS auc, p + q AS n
        FROM ranked JOIN (SELECT setting, fold, count_if(label = 1) AS p, count_if(label = 0) AS q FROM s GROUP BY ALL) c USING (setting, fold)
        GROUP BY setting, fold, p, q ORDER BY ALL""").fetchall()
    got = sorted(map(tuple, MO.fold_auc(spark.read.parquet(path)).collect()))
    assert len(got) == 12 and [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(a[2] - b[2]) < 1e-12 for a, b in zip(got, want))
    for i, mean in enumerate(model.avgMetrics):
        assert abs(mean - sum(r[2] for r in want if r[0] == i) / 3) < 1e-12
    # every row of the train part is held out once a setting
    assert sum(r[3] for r in want) == 4 * train.count()
    best = max(range(4), key=lambda i: model.avgMetrics[i])
    assert MO.fitted_stage(model.bestModel, MO.LogisticRegressionModel).getRegParam() == (0.01, 0.01, 0.5, 0.5)[best]


def test_fold_scores_are_the_models_margins(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F
    rows = spark.range(400).selectExpr("id AS review_id", "double(id % 7) AS normalized_business_review_count", "3.0D AS normalized_user_review_count",
                                       "int(id % 7 + id % 3 > 4) AS label", "1.0D AS class_weight").withColumn("_fold", (F.col("review_id") % 2).cast("int"))
    _, lr = MO.build_pipeline()
    grid = MO.param_grid(lr, (0.01,), (0.0, 0.5))
    models = MO.fit_folds(rows, grid, MO.FEATURE_COLUMNS, lr, 2, 2)
    scores = MO.fold_scores(rows, models, "review_id", MO.FEATURE_COLUMNS)
    assert scores.count() == 800
    for m in models:
        own = m.model.transform(rows.where(F.col("_fold") == m.fold)).select("review_id", vector_to_array("rawPrediction")[1].alias("raw"))
        both = own.join(scores.where((F.col("fold") == m.fold) & (F.col("setting") == m.setting)), "review_id")
        assert both.count() == 200 and both.agg(F.max(F.abs(F.col("raw") - F.col("margin")))).first()[0] < 1e-9


def test_models_score_in_a_session_that_has_observed(spark):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 5}
    rows = spark.range(100).selectExpr("id AS review_id", "double(id % 7) AS normalized_business_review_count", "double(id % 5) AS normalized_user_review_count",
                                       "int(id % 7 > 3) AS label", "1.0D AS class_weight")
    model = MO.cross_validate(rows, folds=2, reg=(0.01,), enet=(0.0,))
    assert model.bestModel.transform(rows).where("prediction = label").count() > 80
    assert not MO.fitted_stage(model.bestModel, MO.LogisticRegressionModel).hasSummary


def test_fits_that_run_at_once_share_no_properties(spark, monkeypatch):
    from pyspark.sql import functions as F
    wrapped, wrap = [], MO.inheritable_thread_target
    monkeypatch.setattr(MO, "inheritable_thread_target", lambda session: lambda f: wrapped.append(f) or wrap(session)(f))
    rows = spark.range(60).selectExpr("id AS review_id", "double(id % 7) AS normalized_business_review_count", "double(id % 5) AS normalized_user_review_count",
                                      "int(id % 7 > 3) AS label", "1.0D AS class_weight").withColumn("_fold", (F.col("review_id") % 2).cast("int"))
    _, lr = MO.build_pipeline()
    models = MO.fit_folds(rows, MO.param_grid(lr, (0.01,), (0.0, 0.5)), MO.FEATURE_COLUMNS, lr, 2, 4)
    assert [(m.fold, m.setting) for m in models] == [(0, 0), (0, 1), (1, 0), (1, 1)] and len(wrapped) == 4


def test_fits_read_a_staged_table_without_a_join_and_held_out_rows_are_whole(spark, tmp_path):
    from pyspark.sql import functions as F
    from ridgeline import registry
    base = {"events": spark.range(600).selectExpr("if(id % 97 = 5, NULL, id) AS event_id", "id % 12 AS user_id", "double(id) AS value",
                                                 "concat('{\"k\": ', id % 9, '}') AS props", "timestamp_seconds(id) AS ts"),
            # 3 comes twice, 4 is NULL, 5 has no row
            "documents": spark.range(20).where("id <> 5").selectExpr("id AS doc_id", "if(id = 4, NULL, repeat('x', int(id))) AS text").unionAll(
                spark.createDataFrame([(3, "again")], "doc_id bigint, text string")),
            "supplier": spark.range(8).selectExpr("id AS s_suppkey", "'n' AS s_name", "double(id) AS s_acctbal"),
            "customer": spark.range(11).selectExpr("id AS c_custkey")}
    for name, table in base.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    d = str(tmp_path)
    features, held_out = registry._signal(spark, d)
    whole = FE.build_features(fx.with_signal(fx.review(spark, d)), fx.business(spark, d), fx.users(spark, d))
    rows = lambda df, cols: sorted(str(tuple(r)) for r in df.select(*cols).collect())
    assert rows(features, features.columns) == rows(whole, features.columns)
    assert "Join" not in features._jdf.queryExecution().optimizedPlan().toString()
    train, test = MO.split_train_test(whole)
    assert held_out.schema.simpleString() == whole.schema.simpleString()
    assert rows(MO.with_label(held_out), test.columns) == rows(test, test.columns) and test.count() > 50
    assert rows(MO.split_train_test(features)[0], features.columns) == rows(train, features.columns)
    assert whole.where(F.col("text") == "again").count() > 0
