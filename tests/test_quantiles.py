"""Exact quantiles by selection equal numpy's linear quantiles, also with heavy duplicates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.plans.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_matches_numpy(spark, limit):
    rng = np.random.default_rng(4)
    x = rng.normal(size=3000)
    x[:1000] = 0.25  # one value holds a third of the rows
    y = rng.integers(0, 7, size=3000).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["x", "y"], PROBS, collect_limit=limit).collect()}
    for (c, p), v in got.items():
        ref = np.quantile(x if c == "x" else y, p)
        assert v == pytest.approx(ref, abs=1e-12), (c, p)


def test_empty_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (None, 3.0)], "a double, b double")
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert got[("a", 0.5)] is None
    assert got[("b", 0.5)] == 2.0


def test_window_collapses_on_duplicates(spark):
    df = spark.range(0, 2000).select(F.when(F.col("id") < 1500, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("v"))
    got = exact_quantiles(df, ["v"], [0.5], collect_limit=10).first()["value"]
    assert got == 5.0


@pytest.mark.parametrize("accuracy", [4, 10_000])
def test_poor_sketches_still_end_exactly(spark, accuracy):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=400), rng.integers(0, 3, 400), [-1e300, 1e300, float("inf")]])
    df = spark.createDataFrame([(float(a),) for a in x], "x double").repartition(3)
    got = {r["p"]: r["value"] for r in exact_quantiles(df, ["x"], [0.3, 0.99], collect_limit=50, accuracy=accuracy).collect()}
    for p, v in got.items():
        assert v == np.quantile(x, p), p


def test_halving_ends_within_64_steps():
    from tablewright.plans.quantiles import _halves, _Target

    for goal in (-np.inf, -3.5, -1e-300, 0.0, 7.0, np.inf):
        t, steps = _Target("x", 0, 1), 0
        while t.lo < t.hi:
            lo, mid = _halves(t)
            if goal <= mid:
                t.hi = mid
            else:
                t.lo = float(np.nextafter(mid, np.inf))
            steps += 1
        assert t.lo == goal and steps <= 65
