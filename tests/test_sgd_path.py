"""Models of several numbers of steps share a run and equal those fitted one by one."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import OneVsRest
from pyspark.ml.linalg import Vectors

from tablewright.jobs import model_queries
from tablewright.jobs import text as text_job
from tablewright.operators.models import classify, sgd


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    rows = [(Vectors.sparse(6, {0: float(a), 1: float(b), 3: 1.0}), float(np.argmax([a, b, 0.2 * rng.normal()])))
            for a, b in rng.normal(size=(90, 2))]
    return spark.createDataFrame(rows, ["features", "label"]).coalesce(1).persist()


def test_an_elastic_net_runs_once(points, monkeypatch):
    rounds, one = [], sgd.SGDTrainer._round
    params = {"alpha": 0.01, "penalty": "elasticnet", "n_classes": 3}
    alone = [classify.sgd_linear(max_iter=s, **params).fit(points).weights for s in (4, 2, 3)]
    monkeypatch.setattr(sgd.SGDTrainer, "_round", lambda self, *a: (rounds.append(1), one(self, *a))[1])
    found = classify.sgd_path(points, [4, 2, 3], **params)
    assert len(rounds) == 4
    for a, b in zip(alone, found):
        np.testing.assert_allclose(a, b.weights)


def test_an_l2_fit_that_ended_serves_higher_limits(points, monkeypatch):
    fits, fit = [], OneVsRest.fit
    params = {"alpha": 0.1, "penalty": "l2", "n_classes": 3}
    alone = [classify.sgd_linear(max_iter=s, **params).fit(points) for s in (1, 150, 200)]
    monkeypatch.setattr(OneVsRest, "fit", lambda self, *a: (fits.append(self.getClassifier().getMaxIter()), fit(self, *a))[1])
    found = classify.sgd_path(points, [1, 150, 200], **params)
    assert fits == [1, 150]
    for a, b in zip(alone, found):
        for x, y in zip(a.models, b.models):
            np.testing.assert_allclose(x.coefficients.toArray(), y.coefficients.toArray())


def test_the_query_searches_the_whole_grid(spark, monkeypatch):
    seen = []

    def run(spark, sf, grid=None, **kw):
        seen.append(grid or text_job.SGD_GRID)
        return spark.createDataFrame([("test", "m", 1.0)], "stage string, model string, accuracy double")

    monkeypatch.setattr(text_job, "run", run)
    model_queries.q_text_job(spark, "")
    assert seen == [text_job.SGD_GRID] and len(text_job.SGD_GRID["max_iter"]) == 3
