"""Isolation forest (M17) and contamination labelling.

Fit: a pool of the ``n_estimators * max_samples`` rows with the smallest
``hash(seed, key)`` (all rows, if there are fewer) is dealt in hash order to the
trees' ``n_estimators * max_samples`` places, over and over until all are
filled.  One scheme for every size: with enough rows the subsamples are
disjoint, with fewer they share rows, and a tree never gets a row twice.  Each
tree is grown by ``groupBy(tree).applyInPandas`` over its ``max_samples`` rows.
The forest is a small node table (at most ``T * (2 * max_samples - 1)``
rows) that is broadcast for scoring by an Arrow-batched pandas UDF.
Score = 2 ** (-E[h(x)] / c(max_samples)) (Liu, Ting & Zhou, 2008).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCol, HasSeed, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions.hashing import hash32
from tablewright.operators.models.persist import ArrayModel
from tablewright.plans.ordered import hash_top_n
from tablewright.plans.parallel import spread
from tablewright.plans.quantiles import exact_quantiles

NODE_SCHEMA = "tree long, node long, feature int, threshold double, left long, right long, size long, leaf boolean"


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(x: np.ndarray, feats: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, len(idx), True])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = x[idx]
        lo, hi = sub[:, feats].min(axis=0), sub[:, feats].max(axis=0)
        usable = np.nonzero(hi > lo)[0]
        if len(usable) == 0:
            return me
        j = usable[rng.integers(len(usable))]
        f = int(feats[j])
        thr = float(rng.uniform(lo[j], hi[j]))
        go_left = sub[:, f] < thr
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me][1:5] = [f, thr, left, right]
        nodes[me][6] = False
        return me

    build(np.arange(len(x)), 0)
    return nodes


class _ForestParams(HasInputCols, HasOutputCol, HasSeed):
    n_estimators = Param(Params._dummy(), "n_estimators", "trees", TypeConverters.toInt)
    max_samples = Param(Params._dummy(), "max_samples", "rows of a tree", TypeConverters.toInt)
    max_features = Param(Params._dummy(), "max_features", "features of a tree: a count, or a share (float)", TypeConverters.identity)
    keyCols = Param(Params._dummy(), "keyCols", "columns that tell rows apart", TypeConverters.toListString)


class IsolationForestModel(Model, HasInputCols, HasOutputCol, ArrayModel):
    """Adds the anomaly score (higher = more anomalous, in (0, 1])."""

    def __init__(self, nodes: pd.DataFrame | None = None, features: Sequence[str] = (), max_samples: int = 0, out: str = "anomaly_score"):
        super().__init__()
        self._set(inputCols=list(features), outputCol=out)
        self.max_samples = max_samples
        if nodes is not None:
            self._flatten(nodes)

    def _flatten(self, nodes: pd.DataFrame) -> None:
        """Flat arrays with a per-tree offset, so one gather walks every tree."""
        self.n_trees = int(nodes["tree"].nunique()) if len(nodes) else 0
        nodes = nodes.sort_values(["tree", "node"])
        sizes = nodes.groupby("tree").size()
        self.roots = np.concatenate([[0], np.cumsum(sizes.to_numpy())[:-1]]).astype(np.int64)[: self.n_trees]
        base = nodes["tree"].map(dict(zip(sizes.index, self.roots))).to_numpy()
        self.feature = nodes["feature"].to_numpy()
        self.threshold = nodes["threshold"].to_numpy()
        self.left = np.where(nodes["leaf"], -1, nodes["left"].to_numpy() + base)
        self.right = np.where(nodes["leaf"], -1, nodes["right"].to_numpy() + base)
        self.leaf_adj = np.array([c_factor(s) for s in nodes["size"]])
        self.leaf = nodes["leaf"].to_numpy(dtype=bool)

    _STATE = ("n_trees", "max_samples", "roots", "feature", "threshold", "left", "right", "leaf_adj", "leaf")

    def _arrays(self):
        return {name: np.asarray(getattr(self, name)) for name in self._STATE}

    def _restore(self, arrays):
        for name in self._STATE:
            setattr(self, name, arrays[name] if arrays[name].ndim else arrays[name].item())

    def _path_lengths(self, x: np.ndarray) -> np.ndarray:
        n = len(x)
        total = np.zeros(n)
        for root in self.roots:
            node = np.full(n, root)
            depth = np.zeros(n)
            active = ~self.leaf[node]
            while active.any():
                nd = node[active]
                go_left = x[active, self.feature[nd]] < self.threshold[nd]
                node[active] = np.where(go_left, self.left[nd], self.right[nd])
                depth[active] += 1
                active = ~self.leaf[node]
            total += depth + self.leaf_adj[node]
        return total / max(self.n_trees, 1)

    def _transform(self, df: DataFrame) -> DataFrame:
        state = self._arrays()
        bc = df.sparkSession.sparkContext.broadcast(state)
        norm = c_factor(self.max_samples) or 1.0

        @F.pandas_udf("double")
        def score(*cols: pd.Series) -> pd.Series:
            model = IsolationForestModel.__new__(IsolationForestModel)
            IsolationForestModel._restore(model, bc.value)
            x = np.column_stack([c.to_numpy(dtype=np.float64) for c in cols])
            return pd.Series(np.power(2.0, -IsolationForestModel._path_lengths(model, x) / norm))

        return spread(df).withColumn(self.getOutputCol(), score(*[F.col(c).cast("double") for c in self.getInputCols()]))


class IsolationForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """M17 as an Estimator, so that it can be searched, put in pipelines and saved."""

    def __init__(self, inputCols: Sequence[str] = (), keyCols: Sequence[str] = (), n_estimators: int = 100,
                 max_samples: int = 256, max_features: int | float = 1.0, seed: int = 0, outputCol: str = "anomaly_score"):
        super().__init__()
        self._set(inputCols=list(inputCols), keyCols=list(keyCols), n_estimators=n_estimators, max_samples=max_samples,
                  max_features=max_features, seed=seed, outputCol=outputCol)

    def _fit(self, df: DataFrame) -> IsolationForestModel:
        features, keys, seed = self.getInputCols(), self.getOrDefault("keyCols"), self.getSeed()
        trees, share = self.getOrDefault("n_estimators"), self.getOrDefault("max_features")
        psi = min(self.getOrDefault("max_samples"), df.count())
        k = share if isinstance(share, int) else max(1, int(round(share * len(features))))
        sample = forest_sample(df, keys, trees, psi, seed)
        sample = sample.select("tree", *[F.col(c).cast("double").alias(c) for c in features])
        grow = _grower(features, min(k, len(features)), seed, int(math.ceil(math.log2(max(psi, 2)))))
        nodes = sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
        # bounded: at most n_estimators * (2 * psi - 1) nodes
        return IsolationForestModel(nodes.toPandas(), features, psi, self.getOutputCol())


def forest_sample(df: DataFrame, keys: Sequence[str], n_trees: int, psi: int, seed: int) -> DataFrame:
    """The rows of every tree, with their ``tree``: ``psi`` different rows each."""
    places = n_trees * psi
    pool = hash_top_n(df.withColumn("_tw_h", hash32(seed, list(keys))), "_tw_h", list(keys), places)
    # at most places rows, a bound set by the parameters: a single-task ranking
    order = Window.orderBy("_tw_h", *keys)
    ranked = pool.withColumn("_tw_rank", F.row_number().over(order) - 1).withColumn(
        "_tw_m", F.count(F.lit(1)).over(Window.partitionBy()))
    place = F.explode(F.sequence(F.col("_tw_rank").cast("long"), F.lit(max(places - 1, 0)).cast("long"), F.col("_tw_m")))
    dealt = ranked.withColumn("_tw_place", place)
    return dealt.withColumn("tree", F.floor(F.col("_tw_place") / F.lit(max(psi, 1))).cast("long")).drop(
        "_tw_h", "_tw_rank", "_tw_m", "_tw_place")


def _grower(features: list[str], k: int, seed: int, max_depth: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        feats = np.sort(rng.choice(len(features), size=k, replace=False))
        rows = _grow(pdf[features].to_numpy(dtype=np.float64), feats, rng, max_depth)
        out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right", "size", "leaf"])
        out.insert(0, "tree", tree)
        return out

    return build


def isolation_forest(df: DataFrame, features: Sequence[str], keys: Sequence[str], n_estimators: int = 100,
                     max_samples: int = 256, max_features: int | float = 1.0, seed: int = 0) -> IsolationForestModel:
    """Fit an isolation forest on ``df``; ``max_features`` is a count or a share of the features."""
    return IsolationForest(features, keys, n_estimators, max_samples, max_features, seed).fit(df)


# M18
def anomaly_label(df: DataFrame, score_col: str, contamination: float, out: str = "anomaly_label") -> DataFrame:
    """-1 for the ``contamination`` share with the highest scores, 1 otherwise (exact quantile threshold)."""
    q = exact_quantiles(df, [score_col], [1.0 - contamination]).first()["value"]
    return df.withColumn(out, F.when(F.col(score_col) > F.lit(q), F.lit(-1)).otherwise(F.lit(1)))
