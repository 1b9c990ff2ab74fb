"""Plan helpers: hash ranks, bounded top-n, salted lookup join, parallelism guard."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.functions.hashing import hash32
from tablewright.operators import evaluate
from tablewright.operators.models import classify
from tablewright.operators.models.trainer import RandomFourierFeatures
from tablewright.plans.joins import lookup_join
from tablewright.plans.ordered import hash_ordinal, hash_top_n
from tablewright.plans.parallel import spread


@pytest.mark.parametrize("per_bucket", [10, 1_000_000])
def test_hash_ordinal_matches_row_number(spark, per_bucket):
    df = spark.range(0, 3000).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("g"))
    df = df.withColumn("h", hash32(9, ["id"]))
    got = hash_ordinal(df, "h", ["id"], partition_by=["g"], out="rn", rows_per_bucket=per_bucket)
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")))
    assert got.join(ref.select("id", "rn2"), "id").filter("rn != rn2").count() == 0
    assert got.count() == 3000


def test_hash_top_n_is_exact(spark):
    df = spark.range(0, 5000).withColumn("h", hash32(3, ["id"]))
    got = [r["id"] for r in hash_top_n(df, "h", ["id"], 37).collect()]
    ref = [r["id"] for r in df.orderBy("h", "id").limit(37).collect()]
    assert sorted(got) == sorted(ref)
    assert hash_top_n(df, "h", ["id"], 10_000).count() == 5000


def test_lookup_join_salted_path_equals_broadcast(spark):
    big = spark.createDataFrame([("hot",)] * 300 + [("a",), ("b",), ("zz",)], "k string")
    small = spark.createDataFrame([("hot", 1), ("a", 2), ("b", 3)], "key string, v int")
    b = lookup_join(big, small, F.col("k"), "key", max_broadcast_rows=100)
    s = lookup_join(big, small, F.col("k"), "key", max_broadcast_rows=0, salt_buckets=8)
    count = lambda d: sorted((r["k"], r["v"]) for r in d.select("k", "v").collect())
    assert count(b) == count(s)
    assert s.count() == 303


def test_spread_decides_from_the_scan(spark, tmp_path):
    rows = spark.range(0, 100, numPartitions=64)
    assert spread(rows).sameSemantics(rows)  # not read from files
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.write.parquet(str(tmp_path / "many"))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan(spread(spark.read.parquet(str(tmp_path / "one"))))
    assert "RebalancePartitions" not in plan(spread(spark.read.parquet(str(tmp_path / "many"))))


def test_adaboost_learns_a_threshold(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 2))
    rows = [(float(a), float(b), float(a > 0.3)) for a, b in x]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, label double"))
    m = classify.adaboost(n_estimators=5, learning_rate=1.0).fit(df)
    assert evaluate.accuracy(m.transform(df), "prediction", "label").first()[0] > 0.95


def test_random_fourier_features_approximate_rbf_kernel(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.5, -0.5)], "x double, y double")
    z = RandomFourierFeatures(["x", "y"], "z", n_components=3000, gamma=0.7, seed=1).transform(df)
    a, b = [np.array(r["z"]) for r in z.collect()]
    assert a.dot(b) == pytest.approx(np.exp(-0.7 * 0.5), abs=0.06)
    assert a.dot(a) == pytest.approx(1.0, abs=0.06)
