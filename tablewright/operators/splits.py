"""Reproducible sampling and splitting (V1-V6).

Row assignment is a function of ``(seed, key)`` only (see
``functions.hashing``), so a split is identical under any partitioning, after
task retries, and equal to what a SQL engine computes from the same key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.hashing import hash32, unit_hash
from tablewright.plans.ordered import hash_ordinal, hash_top_n, ordinal


def assign_split(df: DataFrame, weights: Sequence[float], seed: int, keys: Sequence[str], out: str = "split") -> DataFrame:
    """Add the index of the part each row falls in (weights are normalised)."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    u = unit_hash(seed, keys)
    part = F.lit(0)
    for b in bounds:
        part = part + F.when(u >= F.lit(b), 1).otherwise(0)
    return df.withColumn(out, part.cast("int"))


# V1
def split(df: DataFrame, weights: Sequence[float], seed: int, keys: Sequence[str] | None = None) -> list[DataFrame]:
    """Random split into ``len(weights)`` parts; by key hash when ``keys`` are given.

    Without keys this falls back to ``randomSplit`` (partitioning-dependent).
    """
    if not keys:
        return df.randomSplit(list(weights), seed)
    tagged = assign_split(df, weights, seed, keys, "_tw_split")
    return [tagged.filter(F.col("_tw_split") == i).drop("_tw_split") for i in range(len(weights))]


# V2
def sample_n(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """The first ``n`` rows of a seeded permutation (hash prefilter, then a bounded top-n)."""
    tagged = df.withColumn("_tw_h", hash32(seed, keys))
    return hash_top_n(tagged, "_tw_h", list(keys), n).drop("_tw_h")


# V3
def stratified_folds(
    df: DataFrame, label: str, k: int, seed: int, keys: Sequence[str], out: str = "fold"
) -> DataFrame:
    """Fold = (rank of the row inside its class in seeded order) mod k.

    Every class is spread evenly over the folds.  The rank comes from
    ``hash_ordinal``: hash buckets split every class into bounded groups, so
    a class holding most rows never sits in one task.
    """
    tagged = df.withColumn("_tw_h", hash32(seed, keys))
    ranked = hash_ordinal(tagged, "_tw_h", list(keys), partition_by=[label], out="_tw_rn")
    return ranked.withColumn(out, ((F.col("_tw_rn") - 1) % F.lit(k)).cast("int")).drop("_tw_h", "_tw_rn")


# V4
def shuffle_splits(df: DataFrame, n_splits: int, test_size: float, seed: int, keys: Sequence[str]) -> DataFrame:
    """``n_splits`` independent hold-outs in long form (split_id, <row>, is_test)."""
    ids = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("split_id")
    long = df.select(ids, *df.columns)
    u = unit_hash(seed, [F.col("split_id"), *keys])
    return long.withColumn("is_test", u < F.lit(float(test_size)))


def shuffle_split_flags(df: DataFrame, n_splits: int, test_size: float, seed: int, keys: Sequence[str]) -> DataFrame:
    """Wide form of V4: one boolean ``is_test_<i>`` column per split, no row copies."""
    return df.withColumns(
        {f"is_test_{i}": unit_hash(seed, [F.lit(i), *keys]) < F.lit(float(test_size)) for i in range(n_splits)}
    )


# V5
def folds(df: DataFrame, k: int, seed: int, keys: Sequence[str], out: str = "fold") -> DataFrame:
    """Plain k-fold: fold = hash(seed, key) mod k."""
    return df.withColumn(out, F.pmod(hash32(seed, keys), F.lit(k)).cast("int"))


# V6
def head_tail_split(df: DataFrame, n: int, order: Sequence[str | Column], out: str = "is_head") -> DataFrame:
    """Flag the first ``n`` rows in ``order`` (which must be total)."""
    ranked = ordinal(df, order, out="_tw_rn")
    return ranked.withColumn(out, F.col("_tw_rn") <= F.lit(int(n))).drop("_tw_rn")


def head_tail_split_seeded(df: DataFrame, n: int, seed: int, keys: Sequence[str], out: str = "is_head") -> DataFrame:
    """V6 over a seeded permutation (first ``n`` of V2's order), without a range shuffle."""
    tagged = df.withColumn("_tw_h", hash32(seed, keys))
    ranked = hash_ordinal(tagged, "_tw_h", list(keys), out="_tw_rn")
    return ranked.withColumn(out, F.col("_tw_rn") <= F.lit(int(n))).drop("_tw_h", "_tw_rn")
