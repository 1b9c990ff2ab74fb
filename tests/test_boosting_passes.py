"""AdaBoost reads the rows as often as it has to, and searches read rows whose folds are written."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablewright.jobs import fixtures as fx
from tablewright.jobs import model_queries
from tablewright.operators import splits
from tablewright.operators.models import classify, columns


def _points(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), int(a + 0.4 * b + 0.3 * rng.normal() > 0)) for a, b in rng.normal(size=(300, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).select("features", "label")


def test_trees_know_the_classes_and_cached_rows_are_not_copied(spark, monkeypatch):
    df, seen, fit = _points(spark).persist(), [], DecisionTreeClassifier.fit

    def watched(self, data, params=None):
        seen.append(data.schema["label"].metadata.get("ml_attr", {}).get("num_vals"))
        if len(seen) == 1:
            held.append(len(list(spark.sparkContext._jsc.getPersistentRDDs())))
        return fit(self, data, params)

    held, before = [], len(list(spark.sparkContext._jsc.getPersistentRDDs()))
    df.count()
    monkeypatch.setattr(DecisionTreeClassifier, "fit", watched)
    classify.adaboost(n_estimators=3).fit(df)
    df.unpersist()
    assert seen == [2, 2, 2] and held[0] <= before + 1


def test_votes_follow_the_weighted_errors(spark):
    df = _points(spark).coalesce(1)
    rows, rate = df.collect(), 0.5
    model = classify.adaboost(n_estimators=7, learning_rate=rate).fit(df)  # beyond a checkpoint
    y, w = np.array([r["label"] for r in rows]), np.ones(len(rows))
    for tree, alpha in zip(model.trees, model.alphas):
        wrong = np.array([tree.predict(r["features"]) for r in rows]) != y
        err = w[wrong].sum() / w.sum()
        assert math.isclose(alpha, rate * math.log((1 - err) / err), rel_tol=1e-9)
        w = w * np.exp(alpha * wrong)
    assert len(model.trees) == 7


def test_folds_of_a_search_are_written(spark):
    tr, _ = model_queries._loan_vectors(spark, "/root/testdata/sf0.001")
    rows = model_queries._search_rows(splits.folds(tr, 3, 50, fx.LOAN_KEY))
    assert rows.columns == ["features", "label", "fold"] and rows.count() == tr.count()
    assert "md5" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.schema["label"].metadata["ml_attr"]["vals"]


class _Stopped(Exception):
    pass


def test_the_query_boosts_fifty_rounds(spark, monkeypatch):
    df, seen = _points(spark), []

    def stop(self, rows):
        seen.append(self.getOrDefault("n_estimators"))
        raise _Stopped

    monkeypatch.setattr(model_queries, "_loan_vectors", lambda *_: (df, df))
    monkeypatch.setattr(classify.AdaBoost, "_fit", stop)
    with pytest.raises(_Stopped):
        model_queries.q_adaboost(spark, "")
    assert seen == [50]


def test_rows_are_kept_with_their_weights_once_in_ten_rounds(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(float(a), float(rng.integers(2)), int(a + 0.5 * rng.normal() > 0)) for a in rng.normal(size=300)]
    df = spark.createDataFrame(rows, "a double, c double, label int").coalesce(1)
    kind = {"ml_attr": {"type": "nominal", "vals": ["x", "y"], "name": "c"}}
    df = VectorAssembler(inputCols=["a", "c"], outputCol="features").transform(df.withColumn("c", F.col("c").alias("c", metadata=kind)))
    kept, persist = [], type(df).persist
    monkeypatch.setattr(type(df), "persist", lambda self, *a: (kept.append(self.columns), persist(self, *a))[1])
    before = len(list(spark.sparkContext._jsc.getPersistentRDDs()))
    model = classify.adaboost(n_estimators=12, learning_rate=0.5).fit(df.select("features", "label"))
    assert len(kept) == 2 and len(model.trees) == 12  # before: in every round
    assert len(list(spark.sparkContext._jsc.getPersistentRDDs())) == before
    held = df.collect()
    y, w = np.array([r["label"] for r in held]), np.ones(len(held))
    for tree, alpha in zip(model.trees, model.alphas):
        wrong = np.array([tree.predict(r["features"]) for r in held]) != y
        err = w[wrong].sum() / w.sum()
        assert math.isclose(alpha, 0.5 * math.log((1 - err) / err), rel_tol=1e-9)
        w = w * np.exp(alpha * wrong)


def test_nodes_of_a_fitted_tree_equal_the_saved_ones(spark):
    tree = classify.decision_tree(max_depth=3).fit(_points(spark))
    own, saved = columns.fitted_tree(tree).nodes, columns.read_trees(spark, tree)[0].nodes
    assert len(own) == len(saved) > 3
    for i, node in own.items():
        assert node["prediction"] == saved[i]["prediction"] and node["impurityStats"] == list(saved[i]["impurityStats"])
        assert node["leftChild"] == saved[i]["leftChild"]
        if node["leftChild"] >= 0:
            assert node["split"] == saved[i]["split"].asDict()
