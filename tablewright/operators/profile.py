"""Profiling and aggregation operators (A1-A12) and top-k (L1).

Column statistics are fused into a single ``agg`` (one scan, partial
aggregation on the map side) and returned in long form, one row per column,
with typed doubles instead of the strings ``DataFrame.describe`` returns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.clean import numeric_columns
from tablewright.plans.quantiles import exact_quantiles, value_column


# a variance of this share of the second moment is rounding
ROUNDING = 1e-12


def _stack(df_one_row: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn ``<col>__<field>`` columns of a one-row frame into rows per column."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{f}").alias(f) for f in fields]) for c in cols
    ]
    return df_one_row.select(F.inline(F.array(*structs)))


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.StringType, T.CharType, T.VarcharType))


# A1
def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, stddev, min, max) per column; stddev is the sample form, NaN counts as missing.

    By default all numeric and string columns.  If any listed column is a string, the smallest and largest string
    come in two more columns, ``text_min`` and ``text_max``; its numeric statistics are NULL.
    """
    texts = [c for c in df.columns if _is_text(df, c)]
    cols = list(cols or [c for c in df.columns if c in texts or c in numeric_columns(df)])
    none = F.lit(None)
    aggs = []
    for c in cols:
        text = c in texts
        x = F.col(c) if text else value_column(c)
        aggs += [
            F.count(x).alias(f"{c}__count"),
            (none.cast("double") if text else F.avg(x)).alias(f"{c}__mean"),
            (none.cast("double") if text else F.stddev_samp(x)).alias(f"{c}__stddev"),
            (none.cast("double") if text else F.min(x)).alias(f"{c}__min"),
            (none.cast("double") if text else F.max(x)).alias(f"{c}__max"),
            (F.min(x) if text else none.cast("string")).alias(f"{c}__text_min"),
            (F.max(x) if text else none.cast("string")).alias(f"{c}__text_max"),
        ]
    fields = ["count", "mean", "stddev", "min", "max"] + ["text_min", "text_max"] * any(c in texts for c in cols)
    return _stack(df.agg(*aggs), cols, fields)


# A2
def summary(df: DataFrame, cols: Sequence[str] | None = None, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A1 plus exact linear-interpolated quantiles as ``p25``, ``p50``, ``p75`` of numeric columns."""
    cols = list(cols or numeric_columns(df))
    base = describe(df, cols)
    q = exact_quantiles(df, cols, probs)
    names = {float(p): f"p{int(round(p * 100))}" for p in probs}
    wide = q.groupBy("column").agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(n) for p, n in names.items()]
    )
    return base.join(wide, "column", "left")


# A3
def means(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or numeric_columns(df))
    return df.agg(*[F.avg(value_column(c)).alias(c) for c in cols])


# A4
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency per value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(col).asc_nulls_last())


def _plain(df: DataFrame, c: str) -> Column:
    """A value as text that is equal exactly where SQL says so: -0.0 is 0.0, NaN is NaN, binaries and instants as such."""
    kind = df.schema[c].dataType
    x = F.col(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (x + F.lit(0.0)).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.base64(x)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(x).cast("string")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(x.isNotNull(), F.to_json(F.struct(x)))
    return x.cast("string")


# A5
def cardinality(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-NULL values per column, in one pass over the rows.

    Every row gives one (column, value) pair for each column; the pairs are made distinct on the map side before they
    are shuffled, so a value that fills a third of a column leaves each task once.
    """
    cols = list(cols or df.columns)
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), _plain(df, c).alias("v")) for i, c in enumerate(cols)])
    long = df.select(F.explode(pairs).alias("x")).select("x.i", "x.v").where(F.col("v").isNotNull())
    counts = long.distinct().groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(*[F.coalesce(F.max(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).alias(c) for i, c in enumerate(cols)])


PAIR_SCHEMA = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _pearson(df: DataFrame, left: list[str], right: list[str], upper: bool) -> DataFrame:
    """(i, j, r): Pearson r of ``left[i]`` and ``right[j]`` over the rows where both have a value.

    One scan for any number of columns: every task adds up the sums of all pairs as matrix products of its Arrow
    batches (shifted by the column means), and the sums of a pair are added by key.  r is NULL when either column is
    constant on the pair's rows.  ``upper`` keeps the pairs i < j.
    """
    held = list(dict.fromkeys([*left, *right]))
    means = df.agg(*[F.avg(value_column(c)).alias(f"m{k}") for k, c in enumerate(held)]).first()
    shift = np.array([0.0 if m is None else m for m in means])
    at_left, at_right = ([held.index(c) for c in cols] for cols in (left, right))

    def sums(batches):
        total = None
        for batch in batches:
            x = np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns]) - shift
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            a, b, p, q = x[:, at_left], x[:, at_right], there[:, at_left].astype(float), there[:, at_right].astype(float)
            part = np.stack([p.T @ q, a.T @ q, p.T @ b, (a * a).T @ q, p.T @ (b * b), a.T @ b])
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(left), 1) if upper else np.indices(total[0].shape).reshape(2, -1)
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(t[i, j]) for t in total)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    parts = df.select(*[value_column(c).alias(f"x{k}") for k, c in enumerate(held)]).mapInArrow(sums, PAIR_SCHEMA)
    all_of = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n, sx, sy, sxx, syy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "syy"))
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    varies = (vx > n * sxx * ROUNDING) & (vy > n * syy * ROUNDING)  # else the variance is only rounding
    r = F.when(varies, (n * F.col("sxy") - sx * sy) / F.sqrt(F.when(varies, vx * vy)))
    return all_of.select("i", "j", r.alias("r"))


def _named(cols: Sequence[str], index: str) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in cols]), F.col(index) + 1)


# A6
def correlate_with(df: DataFrame, label: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson r of each feature with ``label`` (pairwise-complete rows)."""
    cols = [c for c in (cols or numeric_columns(df)) if c != label]
    return _pearson(df, cols, [label], upper=False).select(_named(cols, "i").alias("feature"), "r")


# A7
def top_correlated(df: DataFrame, label: str, cols: Sequence[str] | None = None) -> DataFrame:
    """A6 ranked by |r| descending (the ranking window runs over one row per feature)."""
    r = correlate_with(df, label, cols).withColumn("abs_r", F.abs("r"))
    w = Window.orderBy(F.col("abs_r").desc_nulls_last(), F.col("feature"))
    return r.withColumn("rank", F.row_number().over(w))


# A8
def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None, digits: int | None = 3) -> DataFrame:
    """Long-form Pearson matrix (col_a, col_b, r) over pairwise-complete rows; the diagonal is 1."""
    cols = list(cols or numeric_columns(df))
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, r double")
    if len(cols) < 2:
        return diagonal
    pairs = _pearson(df, cols, cols, upper=True)
    r = F.col("r") if digits is None else F.round("r", digits)
    a, b = _named(cols, "i"), _named(cols, "j")
    both = F.array(F.struct(a.alias("col_a"), b.alias("col_b"), r.alias("r")), F.struct(b.alias("col_a"), a.alias("col_b"), r.alias("r")))
    return pairs.select(F.inline(both)).unionAll(diagonal)


# A9
def redundant_features(df: DataFrame, threshold: float = 0.82, cols: Sequence[str] | None = None) -> DataFrame:
    """Pairs (upper triangle, in column order) with |r| above ``threshold``."""
    cols = list(cols or numeric_columns(df))
    order = {c: i for i, c in enumerate(cols)}
    m = correlation_matrix(df, cols, digits=None)
    pos = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    return m.filter((pos[F.col("col_a")] < pos[F.col("col_b")]) & (F.abs("r") > F.lit(threshold)))


# A10
def histogram(df: DataFrame, col: str, bins: int = 31) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed.  All bins are returned."""
    spark = df.sparkSession
    x = value_column(col)
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, count long")
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    idx = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("hi"),
    )
    return edges.join(counts, "bin", "left").select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


# A11
def box_stats(df: DataFrame, cols: Sequence[str] | None = None, whisker: float = 1.5) -> DataFrame:
    """Quartiles, IQR fences, whisker ends and outlier count per column."""
    cols = list(cols or numeric_columns(df))
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    quart = q.groupBy("column").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"),
    )
    quart = quart.withColumn("iqr", F.col("q3") - F.col("q1"))
    quart = quart.withColumn("lower_fence", F.col("q1") - F.lit(whisker) * F.col("iqr")).withColumn(
        "upper_fence", F.col("q3") + F.lit(whisker) * F.col("iqr")
    )
    fences = quart.select("column", "lower_fence", "upper_fence").collect()  # one row per column
    aggs = []
    for c, low, high in fences:
        v = value_column(c)
        inside = F.lit(False) if low is None else (v >= F.lit(low)) & (v <= F.lit(high))
        aggs += [
            F.min(F.when(inside, v)).alias(f"{c}__whisker_lo"), F.max(F.when(inside, v)).alias(f"{c}__whisker_hi"),
            F.count_if(~inside & v.isNotNull()).alias(f"{c}__n_outliers"),
        ]
    ends = _stack(df.agg(*aggs), [r[0] for r in fences], ["whisker_lo", "whisker_hi", "n_outliers"])
    return quart.join(ends, "column", "left")


SKETCH_FIELDS = ("count", "total", "min", "max")


# A2 / A11, approximate form
def sketch(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = (), k: int = 400) -> DataFrame:
    """One KLL quantile sketch with count, total, min and max per group and column, in one pass: a table to keep.

    Rows are (by.., column, count, total, min, max, sketch).  A sketch takes a few KB at any number of rows (its rank
    error falls with ``k``: about 0.7 % at 400), sketches of later loads are added with ``merge_sketches``, and
    nothing is computed again from the rows.
    """
    cols, by = list(cols or numeric_columns(df)), list(by)
    cols = [c for c in cols if c not in by]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), value_column(c).alias("x")) for c in cols])
    long = df.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p.column", "_p.x").where(F.col("x").isNotNull())
    return long.groupBy(*by, "column").agg(
        F.count("x").alias("count"), F.sum("x").alias("total"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.kll_sketch_agg_double("x", F.lit(int(k))).alias("sketch"),
    )


def merge_sketches(*tables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One sketch per group and column of several tables of ``sketch``; fewer ``by`` columns merge groups."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy(*by, "column").agg(
        F.sum("count").alias("count"), F.sum("total").alias("total"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def sketch_summary(sketches: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A2 from sketches: (by.., column, count, mean, min, max, p25, p50, p75); quantiles are values of the column."""
    groups = [c for c in sketches.columns if c not in (*SKETCH_FIELDS, "column", "sketch")]
    quantiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"p{int(round(p * 100))}") for p in probs]
    return sketches.select(*groups, "column", "count", (F.col("total") / F.col("count")).alias("mean"), "min", "max", *quantiles)


def sketch_box(sketches: DataFrame, whisker: float = 1.5) -> DataFrame:
    """A11 from sketches: quartiles, fences and the approximate share of the rows outside them."""
    groups = [c for c in sketches.columns if c not in (*SKETCH_FIELDS, "column", "sketch")]
    q1, median, q3 = (F.kll_sketch_get_quantile_double("sketch", F.lit(p)) for p in (0.25, 0.5, 0.75))
    rows = sketches.select(*groups, "column", "count", "min", "max", q1.alias("q1"), median.alias("median"), q3.alias("q3"), "sketch")
    iqr = F.col("q3") - F.col("q1")
    rows = rows.withColumns({"iqr": iqr, "lower_fence": F.col("q1") - whisker * iqr, "upper_fence": F.col("q3") + whisker * iqr})
    # the share beyond a fence, from the sketch's quantiles in steps of half a percent
    steps = F.array(*[F.lit(i / 200) for i in range(1, 200)])
    values = F.kll_sketch_get_quantile_double("sketch", steps)
    below = F.when(F.col("lower_fence") <= F.col("min"), 0.0).otherwise(F.size(F.filter(values, lambda x: x < F.col("lower_fence"))) / 200)
    above = F.when(F.col("upper_fence") >= F.col("max"), 0.0).otherwise(F.size(F.filter(values, lambda x: x > F.col("upper_fence"))) / 200)
    return rows.withColumn("outlier_share", below + above).drop("sketch")


# A12
def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and share per class; the share window runs over one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))


# L1
def top_k(df: DataFrame, by: Sequence[str | Column], k: int, cols: Sequence[str] | None = None) -> DataFrame:
    """First ``k`` rows by ``by`` (pass ``F.col(x).desc()`` for descending); a bounded TakeOrderedAndProject."""
    order = [F.col(b) if isinstance(b, str) else b for b in by]
    out = df.orderBy(*order).limit(int(k))
    return out.select(*cols) if cols else out
