"""Profiling on constant, NaN, string and wide columns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import profile

NAN = float("nan")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1.0, 5.0, "b", None), (2.0, 5.0, "a", None), (NAN, 5.0, None, None), (3.0, 5.0, "c", None), (None, 5.0, "", None)]
    return spark.createDataFrame(rows, "x double, k double, s string, n double")


def test_nan_is_missing_and_strings_are_described(odd):
    rows = {r["column"]: r for r in profile.describe(odd).collect()}
    assert set(rows) == {"x", "k", "s", "n"}
    assert (rows["x"]["count"], rows["x"]["mean"], rows["x"]["max"]) == (3, 2.0, 3.0)
    assert (rows["s"]["count"], rows["s"]["text_min"], rows["s"]["text_max"], rows["s"]["mean"]) == (4, "", "c", None)
    assert rows["n"]["count"] == 0 and rows["n"]["mean"] is None
    full = {r["column"]: r for r in profile.summary(odd, ["x", "k"]).collect()}
    assert full["x"]["p50"] == 2.0 and full["x"]["mean"] == 2.0 and full["k"]["stddev"] == 0.0


def test_histogram_skips_nan(odd):
    rows = profile.histogram(odd, "x", 2).orderBy("bin").collect()
    assert [(r["lo"], r["hi"], r["count"]) for r in rows] == [(1.0, 2.0, 1), (2.0, 3.0, 2)]


def test_constant_columns_have_no_correlation(odd):
    rows = {r["feature"]: r["r"] for r in profile.correlate_with(odd, "x", ["k", "n"]).collect()}
    assert rows == {"k": None, "n": None}
    cells = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(odd, ["x", "k"]).collect()}
    assert cells == {("x", "k"): None, ("k", "x"): None, ("x", "x"): 1.0, ("k", "k"): 1.0}
    assert profile.redundant_features(odd, 0.5, ["x", "k", "n"]).count() == 0
    assert profile.top_correlated(odd, "x", ["k", "n"]).count() == 2


def test_the_same_pair_at_every_width(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(200, 40))
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], [f"c{i}" for i in range(40)])
    df = df.withColumn("c39", F.when(F.col("c39") > 0, F.col("c39")))
    expected = np.corrcoef(data[:, 0], data[:, 1])[0, 1]
    for width in (2, 30, 31, 40):
        cells = profile.correlation_matrix(df, [f"c{i}" for i in range(width)], digits=None)
        assert cells.count() == width * width
        assert cells.where("col_a = 'c0' and col_b = 'c1'").first()["r"] == pytest.approx(expected, abs=1e-12)
    kept = data[:, 39] > 0
    last = profile.correlation_matrix(df, [f"c{i}" for i in range(40)], digits=None)
    got = last.where("col_a = 'c3' and col_b = 'c39'").first()["r"]
    assert math.isclose(got, np.corrcoef(data[kept, 3], data[kept, 39])[0, 1], abs_tol=1e-12)


def test_box_stats_and_cardinality_with_missing_values(odd):
    box = {r["column"]: r for r in profile.box_stats(odd, ["x", "n"]).collect()}
    assert (box["x"]["median"], box["x"]["n_outliers"], box["n"]["median"], box["n"]["n_outliers"]) == (2.0, 0, None, 0)
    assert profile.cardinality(odd).first().asDict() == {"x": 4, "k": 1, "s": 4, "n": 0}
