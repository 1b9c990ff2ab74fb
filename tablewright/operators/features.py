"""Feature transformers (X1-X7) as ``pyspark.ml`` stages.

Estimators are fitted on the training rows only and applied to any other
rows (no leakage of category frequencies or scaling statistics); the
per-column statistics they keep on the driver are one value per level or
per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class FeatureSpec:
    """Which columns play which role in a model."""

    label: str | None = None
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    text: str | None = None
    key: list[str] = field(default_factory=list)


# X1
def index_category(col: str, out: str | None = None, handle_invalid: str = "keep") -> StringIndexer:
    """Level -> index by descending frequency (ties alphabetical); unseen levels get the last index."""
    return StringIndexer(
        inputCol=col, outputCol=out or f"{col}_index", stringOrderType="frequencyDesc", handleInvalid=handle_invalid
    )


# X2
def index_label(col: str, out: str | None = None) -> StringIndexer:
    return index_category(col, out or f"{col}_index", handle_invalid="error")


# X3
def one_hot(cols: Sequence[str], drop_last: bool = False, suffix: str = "_onehot") -> OneHotEncoder:
    """Indicator vectors of index columns: one slot per index, and none for unseen levels.

    The indexer owns unseen levels: one fitted with ``keep`` gives them the last index, which ``drop_last=True``
    turns into the zero vector; every real level then has a slot and no slot is dead.
    """
    return OneHotEncoder(
        inputCols=list(cols), outputCols=[c.replace("_index", "") + suffix for c in cols], dropLast=drop_last,
        handleInvalid="error",
    )


# X4
def assemble(cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


# X5
def feature_pipeline(spec: FeatureSpec, out: str = "features", label_out: str = "label") -> Pipeline:
    """Index + one-hot every categorical column, assemble with the numerics, index the label.

    All categorical columns are indexed by one multi-column indexer, so their
    level frequencies come from a single pass over the training rows.
    """
    stages = []
    if spec.categorical:
        stages.append(StringIndexer(
            inputCols=list(spec.categorical), outputCols=[f"{c}_index" for c in spec.categorical],
            stringOrderType="frequencyDesc", handleInvalid="keep",
        ))
        stages.append(one_hot([f"{c}_index" for c in spec.categorical], drop_last=True))
    stages.append(assemble(list(spec.numeric) + [f"{c}_onehot" for c in spec.categorical], out))
    if spec.label:
        stages.append(index_label(spec.label, label_out))
    outputs = []
    for st in stages:
        for name in ("outputCol", "outputCols"):
            if st.hasParam(name) and st.isDefined(name):
                val = st.getOrDefault(name)
                outputs.extend(val if isinstance(val, list) else [val])
    if len(outputs) != len(set(outputs)):
        raise ValueError(f"output column collision in {outputs}")
    return Pipeline(stages=stages)


# X6
def standardize(input_col: str = "features", out: str = "scaled") -> StandardScaler:
    """Zero mean, unit sample standard deviation (fit on train, apply to test)."""
    return StandardScaler(inputCol=input_col, outputCol=out, withMean=True, withStd=True)


def fit_standardize_columns(train: DataFrame, cols: Sequence[str], ddof: int = 1) -> dict[str, tuple[float, float]]:
    """Column-wise mean and std (``ddof=0`` population, ``1`` sample) in one aggregation."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[std(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def apply_standardize_columns(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - mean) / std; a zero or undefined std gives 0.0 (constant feature)."""
    exprs = {}
    for c, (m, s) in stats.items():
        if s is None or s == 0:
            exprs[c + suffix] = F.when(F.col(c).isNull(), None).otherwise(F.lit(0.0))
        else:
            exprs[c + suffix] = (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
    return df.withColumns(exprs)


# X7
def min_max_scale(input_col: str = "features", out: str = "scaled", lo: float = 0.0, hi: float = 1.0) -> MinMaxScaler:
    return MinMaxScaler(inputCol=input_col, outputCol=out, min=lo, max=hi)


def fit_min_max_columns(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = train.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in cols}


def apply_min_max_columns(df: DataFrame, stats: dict[str, tuple[float, float]], lo: float = 0.0, hi: float = 1.0, suffix: str = "") -> DataFrame:
    """Rescale to [lo, hi]; a constant column maps to the middle of the range."""
    exprs = {}
    for c, (mn, mx) in stats.items():
        if mn is None or mx == mn:
            exprs[c + suffix] = F.when(F.col(c).isNull(), None).otherwise(F.lit((lo + hi) / 2.0))
        else:
            exprs[c + suffix] = (F.col(c).cast("double") - F.lit(mn)) / F.lit(mx - mn) * F.lit(hi - lo) + F.lit(lo)
    return df.withColumns(exprs)
