"""Loan-status classifier on driver data (the flagship job).

lineitem -> derived ratio, missing-row removal, level collapsing (P4, P9,
P14) -> key-hash 80/20 split (V1) -> index / one-hot / assemble fitted on
the training rows (X1-X4) -> gradient-boosted trees, optionally tuned by
3-fold cross-validation (M5, G1) -> class-1 score (E1) -> AUC on scores and
on hard labels (E3, E4).
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.jobs import fixtures as fx
from tablewright.operators import clean, evaluate, features, splits, tuning
from tablewright.operators.models import classify
from tablewright.plans.parallel import spread
from tablewright.session import ensure_checkpoint_dir


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.loan_like(spark, sf_dir)
    df = clean.drop_missing(df)
    df = clean.collapse_levels(df, "l_linestatus", ["O"], "OPEN")
    return df


def spec() -> features.FeatureSpec:
    return features.FeatureSpec(
        label="status",
        numeric=["l_quantity", "l_tax", "l_discount", "unit_price"],
        categorical=["l_returnflag", "l_linestatus"],
        key=fx.LOAN_KEY,
    )


def run(spark: SparkSession, sf_dir: str, grid: dict | None = None, n_estimators: int = 10, max_depth: int = 3,
        seed: int = 1234) -> DataFrame:
    """One row: auc, auc_hard, n_train, n_test, seconds.

    The prepared table feeds the indexer fit, both splits and the encoders,
    so it is spread and persisted once, with the split; it is let go when the
    encoded rows of both are held, before the fits need the memory.  The
    encoded training rows feed every fit of the search; the scored test rows
    (three columns) feed all metrics.
    """
    t0 = time.time()
    df = splits.assign_split(spread(prepared(spark, sf_dir)), [0.8, 0.2], seed, fx.LOAN_KEY).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = (df.filter(F.col("split") == i).drop("split") for i in range(2))
    feat = features.feature_pipeline(spec()).fit(train)
    tr, te = (feat.transform(d).select("features", "label").persist(StorageLevel.MEMORY_AND_DISK) for d in (train, test))
    n_train, n_test = tr.count(), te.count()
    df.unpersist()
    est = classify.gbt(n_estimators=n_estimators, max_depth=max_depth, seed=seed)
    if grid:
        ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC")
        # one fit at a time: each holds its own binned rows and fills all cores
        model = tuning.grid_search(est, grid, ev, folds=3, parallelism=1, seed=seed).fit(tr)
    else:
        model = est.fit(tr)
    scored = evaluate.score(model, te).select("score", "label", "prediction").persist(StorageLevel.MEMORY_AND_DISK)
    a = evaluate.auc(scored, "score", "label").first()["auc"]
    ah = evaluate.auc_hard(scored, "prediction", "label").first()["auc_hard"]
    for d in (scored, te, tr):
        d.unpersist()
    return spark.createDataFrame(
        [(float(a), float(ah), int(n_train), int(n_test), float(time.time() - t0))],
        "auc double, auc_hard double, n_train long, n_test long, seconds double",
    )


def pipeline_model(train: DataFrame, n_estimators: int = 10, max_depth: int = 3, seed: int = 1234):
    """Feature stages and the classifier in one fitted pipeline (for saving / scoring)."""
    stages = features.feature_pipeline(spec()).getStages() + [classify.gbt(n_estimators=n_estimators, max_depth=max_depth, seed=seed)]
    return Pipeline(stages=stages).fit(train)


def scores(spark: SparkSession, sf_dir: str, n_estimators: int = 10, max_depth: int = 3, seed: int = 1234) -> DataFrame:
    """Per-row test predictions of the loan model: (keys, label, score, prediction)."""
    df = prepared(spark, sf_dir)
    train, test = splits.split(df, [0.8, 0.2], seed, fx.LOAN_KEY)
    ensure_checkpoint_dir(spark)
    # written once: the indexers and the passes of the fit read it, without the scan, the split's hash and the shuffle
    held = train.select(*spec().numeric, *spec().categorical, spec().label)
    model = pipeline_model(spread(held).checkpoint(eager=True), n_estimators, max_depth, seed)
    s = evaluate.score(model, test)
    return s.select(*fx.LOAN_KEY, "label", F.round("score", 6).alias("score"), "prediction")
