"""Distributed ordinal / prefix sums equal single-task windows, for any partitioning."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewright.plans.ordered import ordinal, prefix_sum


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_ordinal_matches_row_number(spark, parts):
    df = spark.range(0, 2000).select(
        F.col("id"), (F.col("id") * 7919 % 97).alias("v"), (F.col("id") % 3).alias("g")
    ).repartition(5)
    got = ordinal(df, ["v", "id"], partition_by=["g"], out="rn", num_partitions=parts)
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert got.join(ref, "id").filter("rn != rn2").count() == 0
    assert got.count() == 2000


@pytest.mark.parametrize("parts", [1, 4])
def test_prefix_sum_matches_window(spark, parts):
    df = spark.range(0, 500).select(F.col("id"), (F.col("id") % 11).cast("double").alias("x"), (F.col("id") % 2).alias("g"))
    got = prefix_sum(df, [F.col("id").desc()], ["x"], partition_by=["g"], exclusive=True, num_partitions=parts)
    w = Window.partitionBy("g").orderBy(F.col("id").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ref = df.withColumn("c2", F.coalesce(F.sum("x").over(w), F.lit(0.0)))
    assert got.join(ref, ["id", "g"]).filter("abs(cum_x - c2) > 1e-9").count() == 0


def test_empty_input(spark):
    df = spark.range(0).select(F.col("id"), F.col("id").cast("double").alias("x"))
    assert ordinal(df, ["id"]).count() == 0
    assert prefix_sum(df, ["id"], ["x"]).count() == 0


def test_prefix_sum_with_nulls_totals_and_many_groups(spark, monkeypatch):
    from tablewright.plans import ordered

    monkeypatch.setattr(ordered, "MAX_BROADCAST_ROWS", 10)  # the shuffle join of the offsets
    df = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("x"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("g"), F.col("id") % 300)).alias("g"))
    got = prefix_sum(df, ["id"], ["x"], partition_by=["g"], num_partitions=5, total_prefix="all_")
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.coalesce(F.sum("x").over(w), F.lit(0)).alias("c"),
                    F.coalesce(F.sum("x").over(Window.partitionBy("g")), F.lit(0)).alias("t"))
    assert got.join(ref, "id").filter("cum_x = c and all_x = t").count() == 3000
    rn = ordinal(df, ["id"], partition_by=["g"], num_partitions=5).join(
        df.select(F.col("id").alias("i"), F.row_number().over(Window.partitionBy("g").orderBy("id")).alias("r")), F.col("id") == F.col("i"))
    assert rn.filter("rn = r").count() == 3000
