"""Hyper-parameter search and cross-validation.

Searches run on ``pyspark.ml.tuning``; fold membership is a column
(``foldCol``) computed by ``operators.splits`` so folds are reproducible and
can be stratified.  Results come back as DataFrames.
"""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def find_param(est: Estimator, name: str) -> Param:
    """A parameter of an estimator, or of the one stage of a pipeline that has it.

    ``Stage.name`` picks a stage by its class name, or by its position (``0.name``).
    """
    if isinstance(est, Pipeline):
        stage, _, bare = name.rpartition(".")
        held = [
            s for i, s in enumerate(est.getStages())
            if s.hasParam(bare) and (not stage or stage in (str(i), type(s).__name__))
        ]
        if len(held) != 1:
            raise ValueError(f"{len(held)} pipeline stages have {name!r}; name one as Stage.{bare} or 0.{bare}")
        return held[0].getParam(bare)
    return est.getParam(name)


def param_grid(est: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(find_param(est, name), list(values))
    return b.build()


# G1
def grid_search(est: Estimator, grid: Mapping[str, Sequence] | list, evaluator: Evaluator, folds: int = 3,
                fold_col: str | None = None, parallelism: int = 4, seed: int = 0, collect_sub_models: bool = False) -> CrossValidator:
    maps = grid if isinstance(grid, list) else param_grid(est, grid)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds,
                        parallelism=parallelism, seed=seed, collectSubModels=collect_sub_models)
    if fold_col:
        cv.setFoldCol(fold_col)
    return cv


# G2
def random_sets(est: Estimator, space: Mapping[str, Sequence], n_iter: int, seed: int = 0) -> list[dict]:
    """``n_iter`` different parameter sets drawn (with a seed) from the listed values, or all, if there are fewer."""
    rng = random.Random(seed)
    maps, seen = [], set()
    for _ in range(n_iter * 20):
        if len(maps) >= n_iter:
            break
        choice = tuple((k, rng.choice(list(v))) for k, v in space.items())
        if choice in seen:
            continue
        seen.add(choice)
        maps.append({find_param(est, k): v for k, v in choice})
    return maps


def random_search(est: Estimator, space: Mapping[str, Sequence], n_iter: int, evaluator: Evaluator, seed: int = 0,
                  **kw) -> CrossValidator:
    """Search over ``random_sets``."""
    return grid_search(est, random_sets(est, space, n_iter, seed), evaluator, seed=seed, **kw)


# G3
def repeated_holdout_search(est: Estimator, grid: Mapping[str, Sequence], evaluator: Evaluator, df: DataFrame,
                            split_flags: Sequence[str], parallelism: int = 4) -> DataFrame:
    """Grid over several hold-out splits (boolean ``is_test_i`` columns): validation and train metric per parameter set.

    The rows are persisted once; ``parallelism`` fits run at a time.
    """
    spark, maps = df.sparkSession, param_grid(est, grid)
    held = df.persist()
    try:
        jobs = [(j, i, flag, pm) for i, flag in enumerate(split_flags) for j, pm in enumerate(maps)]

        def one(job):
            j, i, flag, pm = job
            train, test = held.filter(~F.col(flag)), held.filter(F.col(flag))
            model = est.fit(train, pm)
            return j, i, float(evaluator.evaluate(model.transform(test))), float(evaluator.evaluate(model.transform(train)))

        rows = _in_threads(one, jobs, parallelism)
    finally:
        held.unpersist()
    res = spark.createDataFrame(rows, "param_set int, split int, metric double, train_metric double")
    best = res.groupBy("param_set").agg(
        F.avg("metric").alias("mean_metric"), F.stddev("metric").alias("std_metric"),
        F.avg("train_metric").alias("mean_train_metric"))
    return best.join(_params_frame(spark, maps), "param_set")


def _in_threads(work, jobs: Sequence, parallelism: int) -> list:
    """Results in the order of the jobs; each job submits its own Spark jobs."""
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        return pool.map(inheritable_thread_target(work), list(jobs), chunksize=1)


def _params_frame(spark: SparkSession, maps: list) -> DataFrame:
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name))) for i, m in enumerate(maps)]
    return spark.createDataFrame(rows, "param_set int, params string")


# G4
def search_results(spark: SparkSession, model, seconds: float | None = None) -> DataFrame:
    """(param_set, params, mean_metric, std_metric[, seconds]) of a fitted CrossValidatorModel."""
    maps = model.getEstimatorParamMaps()
    avg = list(model.avgMetrics)
    std = list(getattr(model, "stdMetrics", []) or [None] * len(avg))
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), float(a),
             None if s is None else float(s)) for i, (m, a, s) in enumerate(zip(maps, avg, std))]
    out = spark.createDataFrame(rows, "param_set int, params string, mean_metric double, std_metric double")
    return out.withColumn("seconds", F.lit(seconds)) if seconds is not None else out


def _named(params: dict) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name))


# G1 / G4 / S7
def resumable_search(
    est: Estimator, grid: Mapping[str, Sequence] | list, evaluator: Evaluator, df: DataFrame, fold_col: str, folds: int,
    path: str, parallelism: int = 4, train_metric: bool = True,
) -> DataFrame:
    """Cross-validated search that keeps every finished (parameter set, fold) in a table at ``path``.

    A search that was stopped goes on where it ended: sets and folds that the table holds are not fitted again, and
    the result is that of an uninterrupted search.  A finished fit is one Parquet folder, committed as a whole by
    Spark.  Entries are found by the estimator, the parameters' text and the fold, so a search over a larger grid
    reuses what a smaller one left.  Gives (param_set, params, mean_metric, std_metric, mean_train_metric, folds);
    ``search_table`` reads the single fits.
    """
    spark, maps = df.sparkSession, grid if isinstance(grid, list) else param_grid(est, grid)
    names, learner = [_named(m) for m in maps], _learner(est)
    done = {(r["params"], r["fold"]) for r in search_table(spark, path).where(F.col("learner") == learner).collect()}
    jobs = [(j, fold) for fold in range(folds) for j in range(len(maps)) if (names[j], fold) not in done]
    if jobs:
        held = df.persist()

        def one(job: tuple[int, int]) -> None:
            j, fold = job
            began = time.time()
            train, test = held.filter(F.col(fold_col) != fold), held.filter(F.col(fold_col) == fold)
            model = est.fit(train, maps[j])
            metric = float(evaluator.evaluate(model.transform(test)))
            fitted = float(evaluator.evaluate(model.transform(train))) if train_metric else None
            row = (learner, names[j], fold, metric, fitted, time.time() - began)
            key = hashlib.sha256(f"{learner}|{names[j]}|{fold}".encode()).hexdigest()[:32]
            spark.createDataFrame([row], SEARCH_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/fit={key}")

        try:
            _in_threads(one, jobs, parallelism)
        finally:
            held.unpersist()
    table = search_table(spark, path).where((F.col("learner") == learner) & (F.col("fold") < folds))
    order = spark.createDataFrame(list(enumerate(names)), "param_set int, params string")
    each = table.join(F.broadcast(order), "params")  # one row for each set of the grid
    return each.groupBy("param_set", "params").agg(
        F.avg("metric").alias("mean_metric"), F.stddev_samp("metric").alias("std_metric"),
        F.avg("train_metric").alias("mean_train_metric"), F.count(F.lit(1)).alias("folds"),
    )


def best_set(results: DataFrame, maps: list[dict], larger: bool = True) -> dict:
    """The parameter set of the best mean metric in a table of results (ties: the first one)."""
    order = F.col("mean_metric").desc() if larger else F.col("mean_metric").asc()
    return maps[results.orderBy(order, "param_set").first()["param_set"]]


SEARCH_SCHEMA = "learner string, params string, fold int, metric double, train_metric double, seconds double"


def _learner(est: Estimator) -> str:
    """The estimator with the parameters that the grid doesn't set."""
    stages = est.getStages() if isinstance(est, Pipeline) else [est]
    texts = []
    for s in stages:
        own = {p.name: v for p, v in s.extractParamMap().items()}
        texts.append(f"{type(s).__name__}({', '.join(f'{k}={own[k]}' for k in sorted(own))})")
    return " | ".join(texts)


def search_table(spark: SparkSession, path: str) -> DataFrame:
    """The finished fits of a search: learner, params, fold, metric, train_metric, seconds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # only folders that were committed
    found = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/fit=*/_SUCCESS"))
    paths = [str(f.getPath().getParent()) for f in found or []]
    if not paths:
        return spark.createDataFrame([], SEARCH_SCHEMA)
    return spark.read.schema(SEARCH_SCHEMA).parquet(*paths)


# G5
def best_params(model) -> dict:
    """Winning parameters, read from the best model (last stage of a pipeline)."""
    best = model.bestModel
    if hasattr(best, "stages"):
        best = best.stages[-1]
    maps = model.getEstimatorParamMaps()
    metrics = model.avgMetrics
    larger = model.getEvaluator().isLargerBetter()
    i = max(range(len(metrics)), key=lambda j: metrics[j] if larger else -metrics[j])
    return {p.name: v for p, v in maps[i].items()} | {"_metric": metrics[i], "_model": type(best).__name__}


# G6 / G10
def fit_and_report(search: CrossValidator, df: DataFrame) -> tuple[object, dict]:
    """Fit a search and return (model, report with best params, score and wall seconds)."""
    t0 = time.time()
    model = search.fit(df)
    rep = best_params(model)
    rep["_seconds"] = time.time() - t0
    return model, rep


def timed(fn, *args, **kw):
    t0 = time.time()
    out = fn(*args, **kw)
    return out, time.time() - t0


# G7
def refit_best(est: Estimator, model, train: DataFrame):
    maps = model.getEstimatorParamMaps()
    metrics = model.avgMetrics
    larger = model.getEvaluator().isLargerBetter()
    i = max(range(len(metrics)), key=lambda j: metrics[j] if larger else -metrics[j])
    return est.copy(maps[i]).fit(train)


# G8
def cross_val_score(est: Estimator, evaluator: Evaluator, df: DataFrame, fold_col: str, k: int, parallelism: int = 4) -> DataFrame:
    """Per-fold scores of one estimator: (fold, metric).  The rows are persisted once, folds run side by side."""
    held = df.persist()

    def one(i):
        model = est.fit(held.filter(F.col(fold_col) != i))
        return i, float(evaluator.evaluate(model.transform(held.filter(F.col(fold_col) == i))))

    try:
        rows = _in_threads(one, range(k), parallelism)
    finally:
        held.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, metric double")


# G9
def out_of_fold_predict(est: Estimator, df: DataFrame, fold_col: str, k: int, parallelism: int = 4) -> DataFrame:
    """Each row predicted by the model that did not see it during training."""
    held = df.persist()
    try:
        models = _in_threads(lambda i: est.fit(held.filter(F.col(fold_col) != i)), range(k), parallelism)
    finally:
        held.unpersist()
    out = None
    for i, m in enumerate(models):
        part = m.transform(df.filter(F.col(fold_col) == i))
        out = part if out is None else out.unionByName(part)
    return out
