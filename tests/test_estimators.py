"""The library's own estimators: parameters, searches, pipelines, saving; nothing is silently ignored."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablewright.operators import evaluate, tuning
from tablewright.operators.models import anomaly, classify, regress
from tablewright.operators.models.classify import AdaBoostModel
from tablewright.operators.models.trainer import MLPRegressorModel
from tablewright.sources import io


@pytest.fixture(scope="module")
def points(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(240, 3))
    rows = [(i, *map(float, v), float(v[0] + v[1] > 0.2), float(2 * v[0] - v[2])) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double, y double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).withColumn(
        "fold", (F.col("id") % 2).cast("int")).persist()


def test_parameters_reach_the_estimator(spark):
    g = classify.gbt(min_samples_leaf=64, max_features="sqrt", subsample=0.5)
    assert (g.getMinInstancesPerNode(), g.getFeatureSubsetStrategy(), g.getSubsamplingRate()) == (64, "sqrt", 0.5)
    r = classify.regularised_gbt(gamma=0.01, colsample_bytree=0.5, min_child_weight=3)
    assert (r.getMinInfoGain(), r.getFeatureSubsetStrategy(), r.getMinInstancesPerNode()) == (0.01, "0.5", 3)
    assert classify.random_forest(max_features=None).getFeatureSubsetStrategy() == "all"
    for bad in ({"bogus": 1}, {"colsample": 0.5}):
        with pytest.raises(TypeError):
            classify.gbt(**bad)
    with pytest.raises(ValueError):
        classify.regularised_gbt(reg_lambda=1.0)


def test_search_and_reload_of_a_python_estimator(points, tmp_path, spark):
    ev = BinaryClassificationEvaluator(rawPredictionCol="score")
    cv = tuning.grid_search(classify.adaboost(n_estimators=3), {"learning_rate": [0.1, 1.0]}, ev, folds=2, fold_col="fold")
    model = cv.fit(points)
    io.save_search(model, str(tmp_path / "s"), tuning.search_results(spark, model))
    back, results = io.load_search(spark, str(tmp_path / "s"))
    assert results.count() == 2 and isinstance(back.bestModel, AdaBoostModel)
    a, b = (m.transform(points).orderBy("id").select("score").collect() for m in (model, back))
    assert a == b
    io.save_search(model, str(tmp_path / "bare"))
    assert io.load_search(spark, str(tmp_path / "bare"))[1] is None


def test_forest_is_one_scheme_for_every_size(points, spark, tmp_path):
    for n, trees, psi in ((240, 4, 16), (64, 4, 16), (63, 4, 16), (16, 4, 16), (5, 3, 5)):
        dealt = anomaly.forest_sample(points.where(F.col("id") < n), ["id"], trees, psi, 1).select("tree", "id").collect()
        by = {t: [r.id for r in dealt if r.tree == t] for t in range(trees)}
        assert all(len(v) == psi == len(set(v)) for v in by.values())
        if n >= trees * psi:
            assert len({r.id for r in dealt}) == trees * psi
    est = anomaly.IsolationForest(["a", "b", "c"], ["id"], n_estimators=10, max_samples=32)
    model = est.fit(points)
    model.save(str(tmp_path / "forest"))
    back = anomaly.IsolationForestModel.load(str(tmp_path / "forest"))
    a, b = (m.transform(points).orderBy("id").select("anomaly_score").collect() for m in (model, back))
    assert a == b and len(a) == 240


def test_stage_parameters_of_a_pipeline(points):
    ev = RegressionEvaluator(labelCol="y", metricName="mae")
    est = regress.svr_rbf(["a", "b", "c"], n_components=16, max_iter=5, label="y")
    maps = tuning.param_grid(est, {"gamma": [0.1, 1.0], "C": [1.0], "1.epsilon": [0.1]})
    assert len(maps) == 2 and {p.name for p in maps[0]} == {"gamma", "C", "epsilon"}
    cv = tuning.grid_search(est, maps, ev, folds=2, fold_col="fold").fit(points)
    assert len(cv.avgMetrics) == 2
    with pytest.raises(ValueError):
        tuning.param_grid(Pipeline(stages=[classify.gbt(), classify.gbt()]), {"maxDepth": [2]})


def test_mlp_parameters_and_reload(points, tmp_path):
    est = regress.mlp_regressor(hidden=(4,), max_iter=10, label="y")
    assert [m[est.alpha] for m in tuning.param_grid(est, {"alpha": [0.1, 1.0]})] == [0.1, 1.0]
    model = est.fit(points, {est.alpha: 0.5})
    model.save(str(tmp_path / "mlp"))
    back = MLPRegressorModel.load(str(tmp_path / "mlp"))
    a, b = (m.transform(points).orderBy("id").select("prediction").collect() for m in (model, back))
    assert a == b


def test_score_of_margin_models_and_without_any(points):
    svc = classify.linear_svm(C=1.0, n_rows=240, max_iter=5)
    scored = evaluate.score(svc.fit(points), points)
    assert evaluate.auc(scored, "score", "label").first()["auc"] > 0.9
    with pytest.raises(ValueError):
        evaluate.score(regress.mlp_regressor(hidden=(2,), max_iter=2, label="y").fit(points), points)
