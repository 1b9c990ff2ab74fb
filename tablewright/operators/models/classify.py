"""Classifier families backed by ``pyspark.ml``.

Each factory returns an unfitted Estimator; fitting runs distributed in the
JVM (tree-level aggregations, L-BFGS / OWL-QN over ``treeAggregate``).
Parameters named after other libraries are translated; parameters with no
Spark counterpart raise instead of being ignored.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Callable, Iterator, Sequence

from pyspark import SparkContext
from pyspark.ml import Estimator, Model, classification
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
    MLWritable, MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.models.columns import fitted_tree
from tablewright.operators.models.forest import RandomForestClassifier

MAX_TREE_DEPTH = 30
UNSUPPORTED = {"min_samples_split", "reg_lambda"}


def _reject(params: dict) -> None:
    """Every keyword that is left over is an error: nothing is ignored."""
    bad = UNSUPPORTED.intersection(params)
    if bad:
        raise ValueError(f"no Spark counterpart for {sorted(bad)}")
    if params.get("loss") == "exponential":
        raise ValueError("exponential loss: use adaboost()")
    if params:
        raise TypeError(f"unknown parameters {sorted(params)}")


def _subset(max_features: str | float | int | None) -> str:
    """Features tried per split as Spark's ``featureSubsetStrategy``; ``None`` means all of them."""
    return "all" if max_features is None else str(max_features)


def _depth(d: int | None) -> int:
    if d is None:
        return MAX_TREE_DEPTH
    if d > MAX_TREE_DEPTH:
        raise ValueError(f"tree depth is capped at {MAX_TREE_DEPTH}")
    return int(d)


# M1 / M2
def logistic(label: str = "label", features: str = "features", family: str = "auto", max_iter: int = 100,
             reg_param: float = 0.0, elastic_net: float = 0.0, C: float | None = None, n_rows: int | None = None,
             **kw) -> LogisticRegression:
    """Logistic regression; ``C`` (inverse strength) maps to ``regParam = 1 / (C * n)``."""
    _reject(kw)
    if C is not None:
        if not n_rows:
            raise ValueError("C needs n_rows to translate to regParam")
        reg_param = 1.0 / (C * n_rows)
    return LogisticRegression(labelCol=label, featuresCol=features, family=family, maxIter=max_iter,
                              regParam=reg_param, elasticNetParam=elastic_net)


# M3
def decision_tree(label: str = "label", features: str = "features", max_depth: int | None = 5, max_bins: int = 32,
                  impurity: str = "gini", min_samples_leaf: int = 1, seed: int = 0, **kw) -> DecisionTreeClassifier:
    _reject(kw)
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=_depth(max_depth), maxBins=max_bins,
                                  impurity=impurity, minInstancesPerNode=min_samples_leaf, seed=seed)


# M4
def random_forest(label: str = "label", features: str = "features", n_estimators: int = 20,
                  max_depth: int | None = 5, max_features: str | float | None = "auto", criterion: str = "gini",
                  min_samples_leaf: int = 1, bootstrap: bool = True, seed: int = 0, **kw) -> RandomForestClassifier:
    _reject(kw)
    return RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=n_estimators,
                                  maxDepth=_depth(max_depth), featureSubsetStrategy=_subset(max_features), impurity=criterion,
                                  minInstancesPerNode=min_samples_leaf, bootstrap=bootstrap, seed=seed)


# M5
class GBTClassifier(classification.GBTClassifier):
    """Spark's boosted trees; parameter sets that differ in ``maxIter`` alone share a fit.

    Tree ``i`` depends on the rows, the seed and the trees before it, not on how many follow, so the model of fewer
    iterations is the beginning of the longest one.  A search calls ``fitMultiple`` once for all sets of a fold: its
    rows are read, binned and boosted once for each group of such sets.  With a validation column the number of
    trees depends on the rows, so every set is fitted by itself.
    """

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, Model]]:
        sets = [{**self.extractParamMap(), **m} for m in paramMaps]
        if any(self.validationIndicatorCol in s for s in sets):
            return super().fitMultiple(dataset, paramMaps)
        groups: list[list[int]] = []
        for i, s in enumerate(sets):
            like = [g for g in groups if _but(sets[g[0]], self.maxIter) == _but(s, self.maxIter)]
            like[0].append(i) if like else groups.append([i])
        est = self.copy()

        def group_fit(members: list[int]) -> Callable[[], GBTClassificationModel]:
            longest = max(members, key=lambda i: sets[i][self.maxIter])
            return _once(lambda: est.fit(dataset, paramMaps[longest]))

        shared = [(group_fit(g), g) for g in groups]
        # the first of each group before the others, so that as many fits as there are threads run side by side
        turns = [(g[k], fit) for k in range(max(map(len, groups), default=0)) for fit, g in shared if k < len(g)]
        return _Models((lambda i=i, fit=fit: (i, first_trees(fit(), sets[i][self.maxIter]))) for i, fit in turns)


def _but(params: dict, left_out: Param) -> dict:
    return {p: v for p, v in params.items() if p != left_out}


def _once(work: Callable) -> Callable:
    """``work``, done by the first thread that calls it; the others wait for its result."""
    lock, done = threading.Lock(), []

    def call():
        with lock:
            if not done:
                done.append(work())
            return done[0]

    return call


class _Models:
    """Iterator over what the calls give, for many threads: the next call is picked under a lock and made outside it."""

    def __init__(self, calls):
        self.calls, self.lock = iter(calls), threading.Lock()

    def __iter__(self):
        return self

    def __next__(self):
        with self.lock:
            call = next(self.calls)
        return call()


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The boosting as it was after ``n`` iterations: its first ``n`` trees with their weights."""
    if n >= model.getNumTrees:
        return model
    gateway = SparkContext._active_spark_context._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(gateway.jvm.double, n)
    for i, (tree, weight) in enumerate(zip(model._java_obj.trees()[:n], model.treeWeights)):
        trees[i], weights[i] = tree, weight
    made = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        model.uid, trees, weights, model.numFeatures, model.numClasses)
    return model._copyValues(GBTClassificationModel(made), {model.maxIter: n})


def gbt(label: str = "label", features: str = "features", n_estimators: int = 20, max_depth: int = 5,
        learning_rate: float = 0.1, subsample: float = 1.0, max_features: str | float | None = None,
        min_samples_leaf: int = 1, seed: int = 0, validation_col: str | None = None, checkpoint_interval: int = 10,
        **kw) -> GBTClassifier:
    """Gradient-boosted trees (logistic loss); ``max_features`` is drawn per node."""
    _reject(kw)
    g = GBTClassifier(labelCol=label, featuresCol=features, maxIter=n_estimators, maxDepth=_depth(max_depth),
                      stepSize=learning_rate, subsamplingRate=subsample, featureSubsetStrategy=_subset(max_features),
                      minInstancesPerNode=min_samples_leaf, seed=seed, checkpointInterval=checkpoint_interval)
    if validation_col:
        g.setValidationIndicatorCol(validation_col)
    return g


# M7
def regularised_gbt(label: str = "label", features: str = "features", n_estimators: int = 100, max_depth: int = 6,
                    learning_rate: float = 0.3, gamma: float = 0.0, subsample: float = 1.0,
                    colsample_bytree: float = 1.0, min_child_weight: float = 1.0, seed: int = 0, **kw) -> GBTClassifier:
    """Boosted trees under the names of regularised boosting: ``gamma`` is the least gain of a split,
    ``colsample_bytree`` the share of features (drawn per node, not per tree), ``min_child_weight`` the least rows of
    a child."""
    est = gbt(label, features, n_estimators=n_estimators, max_depth=max_depth, learning_rate=learning_rate,
              subsample=subsample, max_features=None if colsample_bytree >= 1 else float(colsample_bytree),
              min_samples_leaf=max(1, int(round(min_child_weight))), seed=seed, **kw)
    return est.setMinInfoGain(gamma)


# M8
def naive_bayes(label: str = "label", features: str = "features", alpha: float = 0.1) -> NaiveBayes:
    return NaiveBayes(labelCol=label, featuresCol=features, modelType="multinomial", smoothing=alpha)


# M9 / M10 (l2)
def linear_svm(label: str = "label", features: str = "features", C: float = 1.0, n_rows: int | None = None,
               reg_param: float | None = None, max_iter: int = 100, parallelism: int = 4) -> OneVsRest:
    """One-vs-rest linear SVM (hinge loss); ``regParam = 1 / (C * n)`` unless given.

    The per-class binary fits run ``parallelism`` at a time.
    """
    if reg_param is None:
        if not n_rows:
            raise ValueError("C needs n_rows to translate to regParam")
        reg_param = 1.0 / (C * n_rows)
    svc = LinearSVC(regParam=reg_param, maxIter=max_iter)
    return OneVsRest(classifier=svc, labelCol=label, featuresCol=features, parallelism=parallelism)


def sgd_linear(label: str = "label", features: str = "features", alpha: float = 1e-4, penalty: str = "l2",
               max_iter: int = 100, l1_ratio: float = 0.15, n_classes: int | None = None, local_epochs: int = 1, seed: int = 0):
    """Hinge-loss linear model.  ``l2`` uses Spark's LinearSVC per class; ``elasticnet`` takes stochastic steps in
    every partition and averages the models each round (``models.sgd``)."""
    if penalty == "l2":
        return linear_svm(label, features, reg_param=alpha, max_iter=max_iter)
    if penalty == "elasticnet":
        from tablewright.operators.models.sgd import SGDTrainer

        return SGDTrainer(labelCol=label, featuresCol=features, loss="hinge", alpha=alpha, l1_ratio=l1_ratio,
                          maxIter=max_iter, localEpochs=local_epochs, numClasses=n_classes, seed=seed)
    raise ValueError("penalty must be 'l2' or 'elasticnet'")


def sgd_path(df: DataFrame, steps: Sequence[int], **params) -> list:
    """The models of ``sgd_linear(max_iter=s, **params).fit(df)`` for each ``s`` of ``steps``, sharing what they have in common.

    An elastic net's rounds go on from each other, so one run gives all models.  An l2 fit that ended before its limit
    is that of every higher limit too; one that did not is fitted again with the next.
    """
    if params.get("penalty", "l2") == "elasticnet":
        return sgd_linear(max_iter=max(steps), **params).path(df, steps)
    found, ended = {}, None
    for s in sorted(set(steps)):
        found[s] = ended if ended is not None else sgd_linear(max_iter=s, **params).fit(df)
        if all(m.hasSummary and m.summary().totalIterations < s for m in found[s].models):
            ended = found[s]
    return [found[s] for s in steps]


# M11
def perceptron(label: str = "label", features: str = "features", max_iter: int = 50, n_classes: int | None = None,
               local_epochs: int = 1, shuffle: bool = True, seed: int = 0):
    """Averaged perceptron: ``max_iter`` rounds of ``local_epochs`` epochs in every partition (``models.sgd``)."""
    from tablewright.operators.models.sgd import SGDTrainer

    return SGDTrainer(labelCol=label, featuresCol=features, loss="perceptron", maxIter=max_iter, localEpochs=local_epochs,
                      shuffle=shuffle, numClasses=n_classes, seed=seed)


# M12
def mlp_classifier(layers: list[int], label: str = "label", features: str = "features", max_iter: int = 100,
                   block_size: int = 128, tol: float = 1e-6, seed: int = 0) -> MultilayerPerceptronClassifier:
    """Feed-forward classifier; ``layers`` = [n_features, hidden..., n_classes]."""
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=list(layers),
                                          maxIter=max_iter, blockSize=block_size, tol=tol, seed=seed)


def input_width(df, features: str = "features") -> int:
    """Width of an assembled vector column, read from its metadata (no data pass)."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    attrs = meta.get("attrs", {})
    return sum(len(v) for v in attrs.values())


# M6
class _AdaBoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    n_estimators = Param(Params._dummy(), "n_estimators", "most trees", TypeConverters.toInt)
    learning_rate = Param(Params._dummy(), "learning_rate", "factor of each tree's vote", TypeConverters.toFloat)
    max_depth = Param(Params._dummy(), "max_depth", "depth of a tree", TypeConverters.toInt)


class AdaBoost(Estimator, _AdaBoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """SAMME boosting of shallow trees with per-row weights held in a column.

    Each round fits ``DecisionTreeClassifier(weightCol=...)`` (distributed).
    Its weighted error is in the class counts of its leaves, so no pass
    measures it, and the next round's weights are a column expression over
    the features, so the rows are kept once for the whole fit.  The weights
    are worked out from those of at most ``HELD_EVERY`` rounds before, when
    the rows were last kept with them.
    """

    HELD_EVERY = 10

    def __init__(self, n_estimators: int = 50, learning_rate: float = 1.0, max_depth: int = 1, label: str = "label",
                 features: str = "features"):
        super().__init__()
        self._set(n_estimators=n_estimators, learning_rate=learning_rate, max_depth=max_depth, labelCol=label,
                  featuresCol=features, predictionCol="prediction")

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        label, features, rate = self.getLabelCol(), self.getFeaturesCol(), self.getOrDefault("learning_rate")
        held = df.select(features, F.col(label).cast("double").alias(label))
        if not (df.storageLevel.useMemory or df.storageLevel.useDisk):  # rows that a search has cached are not copied
            held = held.persist()
        k, trees, alphas, rounds, older = 2, [], [], self.getOrDefault("n_estimators"), None
        try:
            classes = int(held.agg(F.max(label)).first()[0] or 0) + 1
            k = max(classes, 2)
            # the number of classes in the metadata: no tree looks for it in the rows again
            known = {"ml_attr": {"type": "nominal", "num_vals": classes}} if classes >= 2 else {}
            data = held.select(features, F.col(label).alias(label, metadata=known), F.lit(1.0).alias("_w"))
            for t in range(rounds):
                tree = DecisionTreeClassifier(labelCol=label, featuresCol=features, weightCol="_w",
                                              maxDepth=self.getOrDefault("max_depth"), predictionCol="_p",
                                              rawPredictionCol="_raw", probabilityCol="_prob").fit(data)
                if older is not None:  # the fit has read the rows that were kept since
                    older.unpersist()
                    older = None
                nodes = fitted_tree(tree)
                total = sum(sum(n["impurityStats"]) for n in nodes.leaves())
                err = sum(sum(n["impurityStats"]) - n["impurityStats"][int(n["prediction"])] for n in nodes.leaves()) / total
                if err >= 1.0 - 1.0 / k:
                    break
                err = max(err, 1e-10)
                alpha = rate * (math.log((1 - err) / err) + math.log(k - 1))
                trees.append(tree)
                alphas.append(alpha)
                if err <= 1e-10 or t + 1 == rounds:
                    break
                x = vector_to_array(features)
                found = nodes.column([x[i] for i in range(tree.numFeatures)], lambda n: n["prediction"])
                weight = F.col("_w") * F.when(found != F.col(label), math.exp(alpha)).otherwise(1.0)
                data = data.withColumn("_w", weight)
                if (t + 1) % self.HELD_EVERY == 0:
                    older, held = held, data.persist()
                    data = held
        finally:
            for rows in (held, older):
                if rows is not None:
                    rows.unpersist()
        model = AdaBoostModel(trees, alphas, k)
        return model._set(labelCol=label, featuresCol=features, predictionCol=self.getPredictionCol())


class AdaBoostModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, MLWritable, MLReadable):
    """Weighted votes of the trees: ``prediction`` and ``score``, the share of the votes for class 1."""

    def __init__(self, trees=(), alphas=(), k: int = 2):
        super().__init__()
        self.trees, self.alphas, self.k = list(trees), list(alphas), k

    def _transform(self, df: DataFrame) -> DataFrame:
        out, total = df, float(sum(self.alphas)) or 1.0
        votes = [F.lit(0.0)] * self.k
        for i, (tree, a) in enumerate(zip(self.trees, self.alphas)):
            tree = tree.copy()
            # the predicted class alone: no vectors of counts and shares for each tree
            tree.setPredictionCol(f"_ab_p{i}").setRawPredictionCol("").setProbabilityCol("")
            out = tree.transform(out)
            votes = [v + F.when(F.col(f"_ab_p{i}") == c, F.lit(a)).otherwise(F.lit(0.0)) for c, v in enumerate(votes)]
        out = out.withColumn("_ab_votes", F.array(*votes))
        best = F.array_position(F.col("_ab_votes"), F.array_max(F.col("_ab_votes"))) - 1
        out = out.withColumn("score", F.col("_ab_votes")[1] / F.lit(total))
        out = out.withColumn(self.getPredictionCol(), best.cast("double"))
        return out.drop("_ab_votes", *[f"_ab_p{i}" for i in range(len(self.trees))])

    def write(self) -> MLWriter:
        return _AdaBoostWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _AdaBoostReader()


class _AdaBoostWriter(MLWriter):
    def __init__(self, model: AdaBoostModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"alphas": m.alphas, "k": m.k})
        for i, tree in enumerate(m.trees):
            tree.save(f"{path}/trees/{i}")


class _AdaBoostReader(MLReader):
    def load(self, path: str) -> AdaBoostModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        alphas = metadata["alphas"]
        trees = [DecisionTreeClassificationModel.load(f"{path}/trees/{i}") for i in range(len(alphas))]
        model = AdaBoostModel(trees, alphas, metadata["k"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def adaboost(n_estimators: int = 50, learning_rate: float = 1.0, label: str = "label", features: str = "features",
             max_depth: int = 1) -> AdaBoost:
    return AdaBoost(n_estimators=n_estimators, learning_rate=learning_rate, max_depth=max_depth, label=label, features=features)
