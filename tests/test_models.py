"""Property tests for the model, tuning and source operators."""

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewright.operators import evaluate, tuning
from tablewright.operators.models import anomaly, classify, regress
from tablewright.sources import io


def _toy(spark, n=400):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def test_gbt_probabilities_sum_to_one(spark):
    df = _toy(spark)
    m = classify.gbt(n_estimators=5, max_depth=2).fit(df)
    p = m.transform(df).select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b).alias("s"))
    assert p.filter(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0


def test_trainer_hinge_learns(spark):
    df = _toy(spark)
    m = classify.sgd_linear(alpha=1e-4, penalty="elasticnet", max_iter=20, n_classes=2).fit(df)
    acc = evaluate.accuracy(m.transform(df), "prediction", "label").first()[0]
    assert acc > 0.9


def test_mlp_regressor_fits_linear_target(spark):
    df = _toy(spark).withColumn("t", F.col("a") * 2 + 1)
    m = regress.mlp_regressor(hidden=(8,), alpha=1e-4, max_iter=60, label="t").fit(df)
    mae = evaluate.mae(m.transform(df), "prediction", "t").first()[0]
    assert mae < 0.3


def test_isolation_forest_ranks_planted_outliers(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(v), float(w), 0) for i, (v, w) in enumerate(rng.normal(size=(300, 2)))]
    rows += [(1000 + i, 8.0 + i, -8.0, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    m = anomaly.isolation_forest(df, ["a", "b"], ["id"], n_estimators=20, max_samples=64, seed=3)
    assert evaluate.auc(m.transform(df), "anomaly_score", "y").first()["auc"] > 0.95


def test_search_results_and_save_load(spark, tmp_path):
    df = _toy(spark)
    ev = BinaryClassificationEvaluator(labelCol="label")
    est = classify.decision_tree()
    cv = tuning.grid_search(est, {"maxDepth": [1, 3]}, ev, folds=2, parallelism=2)
    model = cv.fit(df)
    res = tuning.search_results(spark, model)
    assert res.count() == 2
    assert tuning.best_params(model)["maxDepth"] == 3
    io.save_search(model, str(tmp_path / "s"), res)
    back, res2 = io.load_search(spark, str(tmp_path / "s"))
    assert res2.count() == 2
    a = model.transform(df).select("prediction").collect()
    b = back.transform(df).select("prediction").collect()
    assert a == b


def test_unsupported_params_raise():
    for bad in ({"min_samples_split": 2}, {"reg_lambda": 1.0}, {"loss": "exponential"}):
        try:
            classify.gbt(**bad)
        except ValueError:
            continue
        raise AssertionError(f"{bad} must raise")
