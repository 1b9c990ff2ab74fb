"""Projection, derived columns and missing-data operators.

Every operator is ``DataFrame -> DataFrame`` (usable with ``df.transform``)
and is built from Catalyst expressions only, so filters and projections
reach the Parquet scan and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.plans.joins import lookup_join

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOATING_TYPES = (T.FloatType, T.DoubleType)


def _type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(_type_of(df, name), FLOATING_TYPES)


def missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for float/double columns (the notion ``na.drop`` uses)."""
    c = F.col(name)
    return (c.isNull() | F.isnan(c)) if is_floating(df, name) else c.isNull()


# P1
def select_columns(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*cols)


# P2
def drop_columns(df: DataFrame, cols: Iterable[str], strict: bool = True) -> DataFrame:
    cols = list(cols)
    unknown = [c for c in cols if c not in df.columns]
    if strict and unknown:
        raise ValueError(f"unknown columns {unknown}; have {df.columns}")
    return df.drop(*cols)


# P3
def scale_by(df: DataFrame, col: str, k: float, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, F.col(col).cast("double") * F.lit(float(k)))


# P4
def ratio(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """``num / den`` as double; NULL where the denominator is 0 or NULL."""
    return df.withColumn(out, F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")))


# P5
def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


# P6
def nan_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN count for float/double columns; 0 for every other type."""
    cols = list(cols or df.columns)
    return df.agg(
        *[(F.count_if(F.isnan(F.col(c))) if is_floating(df, c) else F.lit(0).cast("long")).alias(c) for c in cols]
    )


# P7
def columns_with_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """How many columns hold at least one NULL (or NaN), in one pass."""
    cols = list(cols or df.columns)
    flags = [F.max(missing(df, c).cast("int")) for c in cols]
    total = flags[0]
    for f in flags[1:]:
        total = total + f
    return df.agg(F.coalesce(total, F.lit(0)).cast("long").alias("n_columns_with_missing"))


# P8
def missing_fraction(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cols = list(cols or df.columns)
    n = F.count(F.lit(1)).cast("double")
    return df.agg(*[(F.lit(1.0) - F.try_divide(F.count(F.col(c)).cast("double"), n)).alias(f"{c}_missing") for c in cols])


# P9 / P10 / P11
def drop_missing(
    df: DataFrame,
    how: str = "any",
    min_non_null: int | None = None,
    subset: Sequence[str] | None = None,
) -> DataFrame:
    """Drop rows with missing values (NULL, or NaN in float columns).

    ``min_non_null=k`` keeps rows with at least ``k`` present values.
    """
    cols = list(subset or df.columns)
    if min_non_null is not None:
        present = None
        for c in cols:
            term = F.when(missing(df, c), 0).otherwise(1)
            present = term if present is None else present + term
        return df.filter(present >= F.lit(int(min_non_null)))
    flags = [missing(df, c) for c in cols]
    if how == "any":
        cond = None
        for f in flags:
            cond = ~f if cond is None else cond & ~f
    elif how == "all":
        cond = None
        for f in flags:
            cond = ~f if cond is None else cond | ~f
    else:
        raise ValueError("how must be 'any' or 'all'")
    return df.filter(cond)


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is present."""
    return drop_missing(df, "any", subset=cols)


# P12
def fill_missing(df: DataFrame, values: Mapping[str, object], nan_too: bool = False) -> DataFrame:
    """NULL -> constant; the literal is cast to the column type (ANSI-safe)."""
    exprs = {}
    for c, v in values.items():
        lit = F.lit(v).cast(_type_of(df, c))
        col = F.col(c)
        if nan_too and is_floating(df, c):
            col = F.when(F.isnan(col), None).otherwise(col)
        exprs[c] = F.coalesce(col, lit)
    return df.withColumns(exprs)


# P13
def _range_pred(col: str, lo, hi, inclusive: tuple[bool, bool]) -> Column:
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= F.lit(lo)) if inclusive[0] else (c > F.lit(lo)))
    if hi is not None:
        cond = cond & ((c <= F.lit(hi)) if inclusive[1] else (c < F.lit(hi)))
    return F.coalesce(cond, F.lit(False))


def trim_outliers(
    df: DataFrame,
    bounds: Mapping[str, tuple[float | None, float | None]],
    inclusive: tuple[bool, bool] = (True, False),
) -> DataFrame:
    """Keep rows inside every ``[lo, hi)`` range (NULL is outside)."""
    cond = F.lit(True)
    for c, (lo, hi) in bounds.items():
        cond = cond & _range_pred(c, lo, hi, inclusive)
    return df.filter(cond)


def trim_report(
    df: DataFrame,
    bounds: Mapping[str, tuple[float | None, float | None]],
    inclusive: tuple[bool, bool] = (True, False),
) -> DataFrame:
    """Dropped-row counts from the very predicate ``trim_outliers`` applies.

    One row: ``n_rows``, ``<col>_dropped`` per bound and ``n_kept``.
    """
    preds = {c: _range_pred(c, lo, hi, inclusive) for c, (lo, hi) in bounds.items()}
    allp = F.lit(True)
    for p in preds.values():
        allp = allp & p
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(~p).alias(f"{c}_dropped") for c, p in preds.items()],
        F.count_if(allp).alias("n_kept"),
    )


# P14
def collapse_levels(df: DataFrame, col: str, levels: Sequence[str], into: str, out: str | None = None) -> DataFrame:
    c = F.col(col)
    return df.withColumn(out or col, F.when(c.isin(list(levels)), F.lit(into)).otherwise(c))


# P15
def collapse_rare(
    df: DataFrame,
    col: str,
    min_count: int,
    into: str,
    out: str | None = None,
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Levels seen fewer than ``min_count`` times become ``into``.

    Level counts are a partial (map-side) aggregation; the rare-level table is
    joined back by ``lookup_join``, which broadcasts it only after checking
    its size and otherwise salts the join so a hot level cannot pile up in
    one task.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_tw_level_n"))
    rare = counts.filter(F.col("_tw_level_n") < F.lit(int(min_count))).select(
        F.col(col).alias("_tw_level"), F.lit(True).alias("_tw_rare")
    )
    joined = lookup_join(df, rare, F.col(col), "_tw_level", max_broadcast_rows=max_broadcast_rows)
    c = F.col(col)
    return joined.withColumn(out or col, F.when(F.col("_tw_rare"), F.lit(into)).otherwise(c)).drop(
        "_tw_level", "_tw_rare"
    )


# P16
def recode(df: DataFrame, col: str, mapping: Mapping[object, object], out: str | None = None, keep_unmapped: bool = True) -> DataFrame:
    c = F.col(col)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    expr = expr.otherwise(c) if keep_unmapped else expr
    return df.withColumn(out or col, expr)


# P17
def clip(df: DataFrame, col: str, lo: float | None, hi: float | None, out: str | None = None) -> DataFrame:
    c = F.col(col)
    e = c
    if lo is not None:
        e = F.greatest(e, F.lit(lo))
    if hi is not None:
        e = F.least(e, F.lit(hi))
    return df.withColumn(out or col, F.when(c.isNull(), None).otherwise(e))


# P18
def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    exclude = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    exclude = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]
