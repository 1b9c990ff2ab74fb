"""Fraud detection on driver data: unsupervised isolation forest vs supervised ensembles.

profile (class balance, correlations with the label, box statistics) ->
seeded stratified folds -> isolation-forest grid scored by fold AUC ->
refit on all training rows -> test scores, AUC on scores and on the
contamination labels -> searches over supervised forest / boosting /
AdaBoost on the same folds -> one comparison table of AUCs.

The searches keep every finished fit in a table (``tuning.resumable_search``):
given a ``path``, a job that was stopped goes on where it ended.
"""

from __future__ import annotations

import uuid

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.jobs import fixtures as fx
from tablewright.operators import evaluate, profile, splits, tuning
from tablewright.operators.models import anomaly, classify
from tablewright.session import ensure_checkpoint_dir

FEATURES = [f"v{i + 1}" for i in range(fx.FRAUD_DIMS)]
FOLDS = 3
# The searched spaces, as far as Spark has the parameter.
FOREST_GRID = {"n_estimators": [100, 150, 200, 250], "max_features": [1, 10, 15, 20, 25, 28]}
DEPTHS = [3, 5, 10, 15, 20, 25, 30]
LEAVES = [1, 2, 4, 8, 16, 32, 64]
SUPERVISED = {
    "random_forest": (100, {
        "maxDepth": DEPTHS, "featureSubsetStrategy": ["sqrt", "log2", "all"], "minInstancesPerNode": LEAVES,
        "bootstrap": [True, False], "impurity": ["gini", "entropy"]}),
    "gbt": (100, {
        "stepSize": [10 ** (-5 + 5 * i / 11) for i in range(12)], "maxDepth": DEPTHS, "minInstancesPerNode": LEAVES,
        "subsamplingRate": [0.1, 0.2, 0.5, 0.9, 1.0], "featureSubsetStrategy": ["sqrt", "log2", "all"]}),
    "regularised_gbt": (50, {
        "minInfoGain": [0.0, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0, 10.0, 100.0], "maxDepth": [6, 9, 12],
        "subsamplingRate": [0.5, 0.9, 1.0], "featureSubsetStrategy": ["0.5", "0.9", "all"]}),
    "adaboost": (50, {"learning_rate": [10 ** (-5 + 5 * i / 49) for i in range(50)]}),
}


def profile_tables(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "class_balance": profile.class_balance(df, "Class"),
        "top_correlated": profile.top_correlated(df, "Class", FEATURES),
        "box_stats": profile.box_stats(df, FEATURES),
    }


def searched(est, maps: list[dict], folded: DataFrame, column: str, path: str) -> tuple:
    """(model of the best parameters fitted on all rows, its mean fold AUC, its mean AUC on the rows it learned from)."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=column, labelCol="label")
    table = tuning.resumable_search(est, maps, ev, folded, "fold", FOLDS, path).persist()
    best = tuning.best_set(table, maps)
    top = table.orderBy(F.col("mean_metric").desc(), "param_set").first()
    table.unpersist()
    return est.copy(best).fit(folded), top["mean_metric"], top["mean_train_metric"]


def estimators(n_estimators: int, seed: int) -> dict:
    return {
        "random_forest": classify.random_forest(n_estimators=n_estimators, seed=seed),
        "gbt": classify.gbt(n_estimators=n_estimators, seed=seed),
        "regularised_gbt": classify.regularised_gbt(n_estimators=n_estimators, seed=seed),
        "adaboost": classify.adaboost(n_estimators=n_estimators),
    }


def run(spark: SparkSession, sf_dir: str, grid: dict | None = None, seed: int = 50, n_estimators: int = 50,
        spaces: dict | None = None, path: str | None = None) -> DataFrame:
    """(model, auc, cv_auc, train_auc): the searched forest and the searched supervised ensembles.

    ``auc`` is of the held-out rows, ``cv_auc`` and ``train_auc`` are the winning parameters' means over the folds.
    ``spaces``: {model: (sets to draw, {param: values})}; by default ``SUPERVISED`` in full.
    """
    folder = path or f"{ensure_checkpoint_dir(spark)}/tw-fraud-{uuid.uuid4().hex}"
    df = fx.fraud_like(spark, sf_dir).withColumn("label", F.col("Class").cast("double"))
    df = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df).checkpoint(eager=True)
    tagged = splits.assign_split(df, [0.7, 0.3], seed, ["vec_id"])
    train, test = tagged.filter("split = 0").drop("split"), tagged.filter("split = 1").drop("split")
    folded = splits.stratified_folds(train, "Class", FOLDS, seed, ["vec_id"]).checkpoint(eager=True)
    forest = anomaly.IsolationForest(FEATURES, ["vec_id"], max_samples=256, seed=seed)
    maps = tuning.param_grid(forest, grid or FOREST_GRID)
    model, cv, own = searched(forest, maps, folded, "anomaly_score", f"{folder}/isolation_forest")
    scored = model.transform(test)
    rate = train.agg(F.avg("Class")).first()[0]
    labelled = anomaly.anomaly_label(scored, "anomaly_score", float(rate)).withColumn(
        "flag", (F.col("anomaly_label") == -1).cast("int"))
    results = [
        ("isolation_forest", evaluate.auc(scored, "anomaly_score", "Class").first()["auc"], cv, own),
        ("isolation_forest_hard", evaluate.auc_hard(labelled, "flag", "Class").first()["auc_hard"], None, None),
    ]
    built = estimators(n_estimators, seed)
    for name, (sets, space) in (spaces or SUPERVISED).items():
        column = "score" if name == "adaboost" else "rawPrediction"
        maps = tuning.random_sets(built[name], space, sets, seed)
        model, cv, own = searched(built[name], maps, folded, column, f"{folder}/{name}")
        results.append((name, evaluate.auc(evaluate.score(model, test), "score", "label").first()["auc"], cv, own))
    rows = [(k, *(None if v is None else float(v) for v in values)) for k, *values in results]
    return spark.createDataFrame(rows, "model string, auc double, cv_auc double, train_auc double")
