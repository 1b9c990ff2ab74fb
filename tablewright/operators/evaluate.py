"""Scoring, evaluation and diagnostics.

ROC, PR and AUC are computed from per-score-value counts and distributed
running sums (``plans.ordered.prefix_sum``), never from a window over the
whole table, so they scale with the number of distinct scores.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.plans.ordered import following, ordinal, prefix_sum


def _is_pos(label: str, pos_label) -> Column:
    return (F.col(label) == F.lit(pos_label)).cast("long")


# E1
def score(model, df: DataFrame, prob_col: str = "probability", out: str = "score", index: int = 1) -> DataFrame:
    """Apply a fitted model and expose the class-``index`` probability as ``out``.

    A margin model (no probability) gives the class's raw margin instead; a
    model that already adds ``out`` is left as it is.
    """
    pred = model.transform(df)
    if prob_col in pred.columns:
        return pred.withColumn(out, vector_to_array(F.col(prob_col))[index])
    if out in pred.columns:
        return pred
    raw = "rawPrediction" if "rawPrediction" in pred.columns else None
    if raw is None:
        raise ValueError(f"the model adds neither {prob_col!r} nor raw predictions, so there is no score")
    return pred.withColumn(out, vector_to_array(F.col(raw))[index])


def _score_counts(df: DataFrame, score_col: str, label: str, pos_label, groups: Sequence[str]) -> DataFrame:
    pos = _is_pos(label, pos_label)
    return (
        df.filter(F.col(score_col).isNotNull() & F.col(label).isNotNull())
        .groupBy(*groups, F.col(score_col).cast("double").alias("threshold"))
        .agg(F.sum(pos).alias("tp"), F.sum(F.lit(1) - pos).alias("fp"))
    )


# E2
def roc_points(
    df: DataFrame, score_col: str, label: str, pos_label=1, groups: Sequence[str] = (), drop_intermediate: bool = False
) -> DataFrame:
    """(threshold, tp, fp, cum_tp, cum_fp, tpr, fpr): one point per distinct score, descending.

    ``drop_intermediate`` leaves out the points inside a straight line: those whose step equals the next one.  The
    next point may lie in another range of scores; the first and the last point of a group always stay.
    """
    groups = list(groups)
    counts = _score_counts(df, score_col, label, pos_label, groups)
    cum = prefix_sum(counts, [F.col("threshold").desc()], ["tp", "fp"], partition_by=groups, total_prefix="all_")
    if drop_intermediate:
        step = F.struct("tp", "fp")
        cum = following(cum, [F.col("threshold").desc()], {"_next": step}, groups)
        first = (F.col("cum_tp") == F.col("tp")) & (F.col("cum_fp") == F.col("fp"))
        cum = cum.filter(first | F.col("_next").isNull() | (F.col("_next") != step))
    return cum.select(
        *groups, "threshold", "tp", "fp", "cum_tp", "cum_fp",
        F.try_divide(F.col("cum_tp").cast("double"), F.col("all_tp").cast("double")).alias("tpr"),
        F.try_divide(F.col("cum_fp").cast("double"), F.col("all_fp").cast("double")).alias("fpr"),
    )


# E3
def auc(df: DataFrame, score_col: str, label: str, pos_label=1, groups: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under the ROC curve (ties handled as one diagonal step).

    area = sum_g fp_g * (TP_before_g + tp_g / 2) / (P * N), ordered by score
    descending; NULL when a class is absent.
    """
    groups = list(groups)
    counts = _score_counts(df, score_col, label, pos_label, groups)
    cum = prefix_sum(counts, [F.col("threshold").desc()], ["tp"], partition_by=groups, exclusive=True)
    part = F.col("fp").cast("double") * (F.col("cum_tp").cast("double") + F.col("tp").cast("double") / 2.0)
    out = cum.groupBy(*groups).agg(
        F.sum(part).alias("_area"), F.sum("tp").cast("double").alias("_P"), F.sum("fp").cast("double").alias("_N")
    )
    return out.select(*groups, F.try_divide(F.col("_area"), F.col("_P") * F.col("_N")).alias("auc"))


# E4
def auc_hard(df: DataFrame, pred: str, label: str, pos_label=1, groups: Sequence[str] = ()) -> DataFrame:
    """AUC of a hard 0/1 prediction: (TPR + TNR) / 2."""
    y = F.col(label) == F.lit(pos_label)
    p = F.col(pred) == F.lit(pos_label)
    out = df.groupBy(*groups).agg(
        F.count_if(y & p).alias("_tp"), F.count_if(y).alias("_P"),
        F.count_if(~y & ~p).alias("_tn"), F.count_if(~y).alias("_N"),
    )
    tpr = F.try_divide(F.col("_tp").cast("double"), F.col("_P").cast("double"))
    tnr = F.try_divide(F.col("_tn").cast("double"), F.col("_N").cast("double"))
    return out.select(*groups, ((tpr + tnr) / 2.0).alias("auc_hard"))


# E5
def compare_roc(scored: Mapping[str, DataFrame], score_col: str, label: str, pos_label=1) -> tuple[DataFrame, DataFrame]:
    """ROC points and AUC of several models in one pass: (model, ...) tables."""
    frames = [d.select(F.lit(name).alias("model"), F.col(score_col).cast("double").alias("_s"), F.col(label).alias("_y")) for name, d in scored.items()]
    allm = frames[0]
    for f in frames[1:]:
        allm = allm.unionByName(f)
    roc = roc_points(allm, "_s", "_y", pos_label, ["model"])
    return roc, auc_from_roc(roc, ["model"])


def auc_from_roc(roc: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """E3 from E2's output: sum fp_g * (cum_tp_g - tp_g / 2) / (P * N); no second ranking pass."""
    part = F.col("fp").cast("double") * (F.col("cum_tp").cast("double") - F.col("tp").cast("double") / 2.0)
    out = roc.groupBy(*groups).agg(
        F.sum(part).alias("_area"), F.sum("tp").cast("double").alias("_P"), F.sum("fp").cast("double").alias("_N")
    )
    return out.select(*groups, F.try_divide(F.col("_area"), F.col("_P") * F.col("_N")).alias("auc"))


# E6
def accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    return df.agg(F.avg((F.col(pred).cast("double") == F.col(label).cast("double")).cast("double")).alias("accuracy"))


# E7
def mae(df: DataFrame, pred: str, label: str) -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(label).cast("double") - F.col(pred).cast("double"))).alias("mae"))


# E8
def r2(df: DataFrame, pred: str, label: str) -> DataFrame:
    """1 - SSE / SST with SST = n * var_pop(y), all in one aggregation over the rows that have both values."""
    both = F.col(label).isNotNull() & F.col(pred).isNotNull()
    y, p = F.when(both, F.col(label).cast("double")), F.col(pred).cast("double")
    out = df.agg(
        F.sum((y - p) * (y - p)).alias("_sse"), F.var_pop(y).alias("_var"), F.count(y).cast("double").alias("_n")
    )
    return out.select((F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_n") * F.col("_var"))).alias("r2"))


# E9
def residuals(df: DataFrame, pred: str, label: str, keep: Sequence[str] = ()) -> DataFrame:
    err = F.col(label).cast("double") - F.col(pred).cast("double")
    return df.select(*keep, F.col(label), F.col(pred), err.alias("error"), F.abs(err).alias("abs_error"))


# E10
def confusion_matrix(df: DataFrame, pred: str, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(F.count(F.lit(1)).alias("count"))


# E11
def pr_points(df: DataFrame, score_col: str, label: str, pos_label=1) -> DataFrame:
    """(threshold, precision, recall) per distinct score, from E2's running counts."""
    roc = roc_points(df, score_col, label, pos_label)
    return roc.select(
        "threshold",
        F.try_divide(F.col("cum_tp").cast("double"), (F.col("cum_tp") + F.col("cum_fp")).cast("double")).alias("precision"),
        F.col("tpr").alias("recall"),
    )


# E12
def best_threshold(df: DataFrame, score_col: str, label: str, pos_label=1) -> DataFrame:
    """ROC point maximising TPR - FPR (Youden's J); ties go to the higher threshold."""
    roc = roc_points(df, score_col, label, pos_label).withColumn("j", F.col("tpr") - F.col("fpr"))
    best = roc.agg(F.max(F.struct("j", "threshold", "tpr", "fpr")).alias("b"))
    return best.select("b.threshold", "b.tpr", "b.fpr", "b.j")


# E13
def residual_by_bucket(df: DataFrame, pred: str, label: str, n: int, keys: Sequence[str]) -> DataFrame:
    """Mean error per ``ntile(n)`` bucket of the true value (order: label, keys)."""
    rows = df.select(label, pred, *keys).filter(F.col(label).isNotNull())  # rank only what the buckets need
    total = rows.count()
    ranked = ordinal(rows, [label, *keys], out="_tw_rn")
    q, r = divmod(total, n) if n else (0, 0)
    rn = F.col("_tw_rn")
    big = F.lit(r * (q + 1))
    # ntile semantics: the first r buckets hold q + 1 rows, the rest q
    bucket = F.when(rn <= big, F.floor((rn - 1) / F.lit(q + 1)) + 1).otherwise(
        F.lit(r) + F.floor((rn - 1 - big) / F.lit(max(q, 1))) + 1
    )
    err = F.col(label).cast("double") - F.col(pred).cast("double")
    return ranked.groupBy(bucket.cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("count"),
        F.min(F.col(label).cast("double")).alias("label_min"),
        F.max(F.col(label).cast("double")).alias("label_max"),
        F.avg(err).alias("mean_error"),
        F.avg(F.abs(err)).alias("mean_abs_error"),
    )
