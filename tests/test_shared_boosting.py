"""A search over boostings: sets that differ in the number of iterations share a fit, with the models of separate fits."""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml import classification
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler

from tablewright.operators import tuning
from tablewright.operators.models import classify


def _points(spark):
    rng = np.random.default_rng(8)
    rows = [(float(a), float(b), int(a + 0.4 * b + 0.3 * rng.normal() > 0)) for a, b in rng.normal(size=(200, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label int").coalesce(1)
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).select("features", "label")


def _count_fits(monkeypatch):
    fits, fit = [], classification.GBTClassifier._fit

    def watched(self, df):
        fits.append(self.getMaxIter())
        return fit(self, df)

    monkeypatch.setattr(classification.GBTClassifier, "_fit", watched)
    return fits


def _text(model):
    return re.sub(r"uid = \w+|uid=\w+", "", model.toDebugString)


def test_models_equal_separate_fits(spark, monkeypatch):
    df = _points(spark)
    est = classify.gbt(n_estimators=2, max_depth=2, subsample=0.7, max_features="sqrt", seed=4)
    maps = tuning.param_grid(est, {"maxDepth": [1, 3], "maxIter": [1, 4, 2]})
    alone = [est.fit(df, m) for m in maps]
    fits = _count_fits(monkeypatch)
    shared = dict(est.fitMultiple(df, maps))
    assert fits == [4, 4] and sorted(shared) == list(range(len(maps)))
    for i, own in enumerate(alone):
        got = shared[i]
        assert _text(got) == _text(own) and got.treeWeights == own.treeWeights
        assert (got.numFeatures, got.numClasses, got.getMaxIter()) == (own.numFeatures, own.numClasses, own.getMaxIter())
        assert got.transform(df).collect() == own.transform(df).collect()


def test_a_search_fits_each_depth_once_a_fold(spark, monkeypatch):
    df = _points(spark)
    est = classify.gbt(n_estimators=2, max_depth=2, seed=1)
    grid, ev = {"maxDepth": [1, 2], "maxIter": [1, 3]}, BinaryClassificationEvaluator(labelCol="label")
    # separate fits: Spark's own estimator
    plain = classification.GBTClassifier(maxIter=2, maxDepth=2, stepSize=0.1, seed=1)
    want = tuning.grid_search(plain, grid, ev, folds=2, seed=3).fit(df)
    fits = _count_fits(monkeypatch)
    got = tuning.grid_search(est, grid, ev, folds=2, seed=3).fit(df)
    assert len(fits) == 2 * 2 + 1  # two depths in two folds, and the best set on all rows
    assert np.allclose(got.avgMetrics, want.avgMetrics, atol=1e-12) and _text(got.bestModel) == _text(want.bestModel)


def test_with_a_validation_column_every_set_is_fitted(spark, monkeypatch):
    df = _points(spark).selectExpr("*", "rand(1) < 0.5 AS held")
    est = classify.gbt(n_estimators=2, max_depth=1, seed=1, validation_col="held")
    fits = _count_fits(monkeypatch)
    models = dict(est.fitMultiple(df, tuning.param_grid(est, {"maxIter": [1, 2]})))
    assert sorted(fits) == [1, 2] and len(models) == 2
