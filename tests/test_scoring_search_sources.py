"""ROC thinning, one-pass cardinality, sketches, quarantine, tree columns, resumable searches."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import evaluate, profile, tuning
from tablewright.operators.models import classify, columns
from tablewright.plans import ordered
from tablewright.sources import io


# ---------------------------------------------------------------- E2

def thinned(points):
    """Positions that stay: both ends, and where the second difference of either count isn't zero."""
    tps, fps = (np.cumsum([p[i] for p in points]) for i in (0, 1))
    if len(points) <= 2:
        return list(range(len(points)))
    inner = np.logical_or(np.diff(fps, 2) != 0, np.diff(tps, 2) != 0)
    return np.flatnonzero(np.r_[True, inner, True]).tolist()


@pytest.mark.parametrize("partitions", [1, 8])
def test_collinear_points_go_across_ranges(spark, partitions):
    rng = np.random.default_rng(partitions)
    rows = []
    for group, size in (("a", 60), ("b", 1), ("c", 25), (None, 2)):
        for s in range(size):
            tp, fp = ((1, 0), (0, 1), (1, 1))[rng.integers(3)] if rng.random() < 0.4 else (0, 1)
            rows += [(group, float(-s), 1)] * tp + [(group, float(-s), 0)] * fp
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        full = evaluate.roc_points(df, "s", "y", groups=["g"]).collect()
        thin = evaluate.roc_points(df, "s", "y", groups=["g"], drop_intermediate=True).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = set()
    for g in {r.g for r in full}:
        held = sorted((r for r in full if r.g == g), key=lambda r: -r.threshold)
        want |= {(g, held[i].threshold) for i in thinned([(r.tp, r.fp) for r in held])}
    assert {(r.g, r.threshold) for r in thin} == want and len(thin) == len(want) < len(full)


def test_following(spark):
    df = spark.createDataFrame([(g, i, i * i) for g in "xy" for i in range(37)] + [("z", 0, 5)], "g string, i int, v int")
    for parts in (1, 50):
        rows = ordered.following(df, ["i"], {"nxt": F.col("v")}, ["g"], num_partitions=parts).collect()
        assert {(r.g, r.i): r.nxt for r in rows} == {
            (g, i): (i + 1) ** 2 if i < 36 else None for g in "xy" for i in range(37)} | {("z", 0): None}


# ---------------------------------------------------------------- A5

def test_cardinality_is_one_pass_over_a_derived_table(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("a"), (F.col("id") % 5 * 0.5).alias("b"),
        F.when(F.col("id") % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("zero"),
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("nan"),
        F.lit(None).cast("string").alias("none"), F.encode(F.col("id").cast("string"), "utf-8").alias("raw"),
        F.timestamp_micros(F.col("id") % 11).alias("at"), F.array(F.col("id") % 4).alias("list"), (F.col("id") % 2 == 0).alias("flag"))
    out = profile.cardinality(df)
    assert out.first().asDict() == {"a": 6, "b": 5, "zero": 1, "nan": 2, "none": 0, "raw": 500, "at": 11, "list": 4, "flag": 2}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 500") == 1
    assert profile.cardinality(df.limit(0)).first().asDict() == dict.fromkeys(df.columns, 0)


# ---------------------------------------------------------------- A2 / A11 sketches

def test_sketches_merge_and_stay_near_the_exact_ranks(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate((rng.normal(size=30_000), rng.exponential(50, 10_000)))
    df = spark.createDataFrame([(int(i % 3), float(v), float(-v)) for i, v in enumerate(x)], "g int, x double, y double").repartition(6)
    loads = [df.where("x < 0"), df.where("x >= 0 and g < 2"), df.where("x >= 0 and g = 2")]
    by_group = profile.merge_sketches(*[profile.sketch(d, ["x", "y"], ["g"]) for d in loads], by=["g"])
    whole = profile.merge_sketches(by_group)
    for table, groups in ((by_group, (0, 1, 2)), (whole, (None,))):
        rows = {(r["g"] if "g" in r else None, r.column): r for r in profile.sketch_summary(table, (0.01, 0.25, 0.5, 0.75, 0.99)).collect()}
        boxes = {(r["g"] if "g" in r else None, r.column): r for r in profile.sketch_box(table).collect()}
        for g in groups:
            for name, sign in (("x", 1), ("y", -1)):
                v = np.sort(sign * (x if g is None else x[np.arange(len(x)) % 3 == g]))
                r, b = rows[g, name], boxes[g, name]
                assert r["count"] == len(v) and np.isclose(r["mean"], v.mean()) and (r["min"], r["max"]) == (v[0], v[-1])
                for p in (1, 25, 50, 75, 99):
                    assert abs(np.searchsorted(v, r[f"p{p}"]) / len(v) - p / 100) < 0.02
                out = np.mean((v < b.lower_fence) | (v > b.upper_fence))
                assert abs(out - b.outlier_share) < 0.03
    plan = profile.sketch(df, ["x", "y"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


# ---------------------------------------------------------------- S1

def test_corrupt_rows_are_kept_and_counted(spark, tmp_path):
    lines = ["1;2.5;a", "x;1.0;b", "3;;c", "4;1.5", "5;1.5;d;e", "6;oops;f", "", "7;0.5;ok"]
    (tmp_path / "part.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType.fromDDL("i int, d double, s string")
    df = io.read_delimited(spark, str(tmp_path), schema, header=False, corrupt="bad")
    rows = {r.bad: (r.i, r.d, r.s) for r in df.collect() if r.bad}
    assert set(rows) == {"x;1.0;b", "4;1.5", "5;1.5;d;e", "6;oops;f"}
    assert rows["x;1.0;b"] == (None, 1.0, "b") and rows["4;1.5"] == (4, 1.5, None)
    good, rejected = io.quarantine(df, "bad")
    assert sorted(r.i for r in good.collect()) == [1, 3, 7] and "bad" not in good.columns and rejected.count() == 4
    assert rejected.select("bad").count() == 4 and good.count() == 3
    assert tuple(io.reject_report(df, "bad").first()) == (7, 3, 4)
    # a row's verdict doesn't depend on the columns that a query reads
    assert df.where(F.col("bad").isNotNull()).select("s").count() == 4
    assert sorted(r.i for r in good.select("i").collect()) == [1, 3, 7]
    with pytest.raises(ValueError):
        io.read_delimited(spark, str(tmp_path), corrupt="bad")


# ---------------------------------------------------------------- E1

@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack((rng.normal(size=(400, 2)), rng.integers(0, 5, 400)))
    y = (x[:, 0] + (x[:, 2] % 2) > 0.4).astype(float) + (x[:, 1] > 1)
    rows = [(i, *map(float, v), float(c), float(c > 0)) for i, (v, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double, two double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw").transform(df)
    # the third feature is categorical, so splits on sets occur
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=6).fit(df).transform(df).persist()


@pytest.mark.parametrize("name", ["tree", "forest", "gbt", "stump", "gbt_regressor", "forest_regressor"])
def test_tree_columns_equal_transform(vectors, name):
    est = {
        "tree": classify.decision_tree(max_depth=6), "forest": classify.random_forest(n_estimators=7, max_depth=5, seed=3),
        "gbt": classify.gbt(label="two", n_estimators=5, max_depth=3), "stump": classify.decision_tree(max_depth=0),
        "gbt_regressor": GBTRegressor(labelCol="label", maxIter=4, maxDepth=3),
        "forest_regressor": RandomForestRegressor(labelCol="label", numTrees=5, maxDepth=4, seed=1),
    }[name]
    model = est.fit(vectors)
    held = model.transform(vectors).withColumnRenamed("prediction", "p")
    for features in ("features", ["a", "b", "c"]):
        rows = columns.score_columns(model, held, features).collect()
        for r in rows:
            own = r.probability[1] if "probability" in held.columns else r.p
            assert r.prediction == pytest.approx(r.p) and r.score == pytest.approx(own, abs=1e-12)


def test_columns_need_no_python(vectors):
    model = classify.decision_tree(max_depth=3).fit(vectors)
    plan = columns.score_columns(model, vectors.select("a", "b", "c"), ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CASE WHEN" in plan
    with pytest.raises(TypeError):
        columns.tree_columns(vectors.sparkSession, classify.logistic(label="two").fit(vectors))


# ---------------------------------------------------------------- G1 / G4 / S7

class Breaking(BinaryClassificationEvaluator):
    """Fails after some evaluations, as a killed driver would."""

    left = 0

    def evaluate(self, dataset, params=None):
        Breaking.left -= 1
        if Breaking.left < 0:
            raise RuntimeError("killed")
        return super().evaluate(dataset)


def test_a_killed_search_resumes(spark, vectors, tmp_path):
    df = vectors.select("id", "features", F.col("two").alias("label"), (F.col("id") % 3).cast("int").alias("fold"))
    est, grid = classify.decision_tree(), {"maxDepth": [1, 3]}
    path = str(tmp_path / "search")
    Breaking.left = 7  # two evaluations a fit
    with pytest.raises(RuntimeError):
        tuning.resumable_search(est, grid, Breaking(labelCol="label"), df, "fold", 3, path, parallelism=1)
    before = tuning.search_table(spark, path).count()
    assert 0 < before < 6
    Breaking.left = 2 * (6 - before)  # exactly what is missing
    found = tuning.resumable_search(est, grid, Breaking(labelCol="label"), df, "fold", 3, path, parallelism=1).collect()
    assert Breaking.left == 0
    plain = tuning.resumable_search(est, grid, BinaryClassificationEvaluator(labelCol="label"), df, "fold", 3, str(tmp_path / "plain")).collect()
    near = lambda rows: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows)
    assert near(found) == near(plain)
    assert all(r.folds == 3 and r.mean_train_metric >= 0.5 for r in found) and {r.param_set for r in found} == {0, 1}
    # other settings of the estimator are other fits
    Breaking.left = 0
    with pytest.raises(RuntimeError):
        tuning.resumable_search(classify.decision_tree(min_samples_leaf=9), grid, Breaking(labelCol="label"), df, "fold", 3, path)


def test_r2_reads_the_rows_that_have_both(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (4.0, 3.5), (100.0, None), (None, 7.0)]
    df = spark.createDataFrame(rows, "y double, p double")
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.5])
    assert evaluate.r2(df, "p", "y").first()[0] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
