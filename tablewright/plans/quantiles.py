"""Exact quantiles without collecting a column into one task.

``percentile(x, p)`` keeps every distinct value of a group in one
aggregation buffer, which for a global quantile means one task holds the
whole column.  Here each requested order statistic is found by selection on
the wide columns, all columns in one aggregation per round:

1. count the values of every column;
2. narrow each target's window ``[lo, hi]`` around its rank with
   ``percentile_approx`` over the values inside the window, and re-anchor it
   with exact counts (values below the window, values inside);
3. once the windows hold at most ``collect_limit`` values together, collect
   them (a fixed, small bound) and pick the exact ranks.

There is one path for every size.  A round divides a window by about the
sketch's accuracy, so a few rounds suffice for any table; a window that
collapses to one value (heavy duplicates) is resolved without collecting, and
one that the sketch cannot narrow is halved (by the doubles in it, so at most 64 times).  The projected columns are
persisted while the rounds run.  Interpolation is linear (``quantile_cont``):
``h = p * (n - 1)``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLLECT_LIMIT = 20_000
ACCURACY = 10_000
TARGETS_PER_PASS = 64


def value_column(c: str) -> Column:
    """The column as double, NaN read as missing."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


class _Target:
    """One order statistic: the ``rank``-th smallest (0-based) value of ``column``."""

    def __init__(self, column: str, rank: int, n: int):
        self.column, self.rank = column, rank
        self.lo, self.hi = -math.inf, math.inf
        self.below, self.inside = 0, n
        self.value: float | None = None

    @property
    def window(self) -> tuple:
        return self.column, self.lo, self.hi


def _inside(window: tuple) -> Column:
    column, lo, hi = window
    v = F.col(column)
    return (v >= F.lit(lo)) & (v <= F.lit(hi))


def _proposals(wide: DataFrame, pending: list[_Target], accuracy: int) -> list[tuple[float, float]]:
    """Approximate bounds around each target; targets with the same window share one sketch."""
    fractions: dict[tuple, list[float]] = {}
    places = []
    d = 2.0 / accuracy
    for t in pending:
        held = fractions.setdefault(t.window, [])
        q = (t.rank - t.below + 0.5) / max(t.inside, 1)
        places.append(len(held))
        held.extend([max(0.0, q - d), min(1.0, q + d)])
    keys = list(fractions)
    aggs = [
        F.percentile_approx(F.when(_inside(k), F.col(k[0])), fractions[k], accuracy).alias(f"b{i}")
        for i, k in enumerate(keys)
    ]
    row = wide.agg(*aggs).first()
    bounds = {k: row[f"b{i}"] for i, k in enumerate(keys)}
    return [(bounds[t.window][j], bounds[t.window][j + 1]) for t, j in zip(pending, places)]


def _anchor(wide: DataFrame, pending: list[_Target], proposals: list[tuple[float, float]]) -> None:
    """Exact counts below and inside the proposed windows; a target moves to the part that holds its rank."""
    counts = []
    for i, (t, (lo, hi)) in enumerate(zip(pending, proposals)):
        v, held = F.col(t.column), _inside(t.window)
        counts.append(F.count_if(held & (v < F.lit(lo))).alias(f"u{i}"))
        counts.append(F.count_if(held & (v >= F.lit(lo)) & (v <= F.lit(hi))).alias(f"w{i}"))
    row = wide.agg(*counts).first()
    for i, (t, (lo, hi)) in enumerate(zip(pending, proposals)):
        under, inside = row[f"u{i}"], row[f"w{i}"]
        if t.rank < t.below + under:
            t.hi, t.inside = float(np.nextafter(lo, -math.inf)), under
        elif t.rank < t.below + under + inside:
            t.lo, t.hi, t.below, t.inside = lo, hi, t.below + under, inside
        else:
            t.lo, t.below, t.inside = float(np.nextafter(hi, math.inf)), t.below + under + inside, t.inside - under - inside
        if t.lo == t.hi:
            t.value = t.lo


def order_statistics(wide: DataFrame, targets: list[_Target], collect_limit: int, accuracy: int) -> None:
    """Set the value of every target."""
    while True:
        pending = [t for t in targets if t.value is None]
        held = sum({t.window: t.inside for t in pending}.values())
        if held <= collect_limit:
            break
        for at in range(0, len(pending), TARGETS_PER_PASS):
            part = pending[at : at + TARGETS_PER_PASS]
            before = [t.inside for t in part]
            _anchor(wide, part, _proposals(wide, part, accuracy))
            stuck = [t for t, n in zip(part, before) if t.value is None and t.inside >= n]
            if stuck:  # the sketch could not narrow the window: halve the value range
                _anchor(wide, stuck, [_halves(t) for t in stuck])
    if pending:
        wanted: dict[str, Column] = {}
        for t in pending:
            held = _inside(t.window)
            wanted[t.column] = held if t.column not in wanted else wanted[t.column] | held
        pairs = [F.struct(F.lit(c).alias("c"), F.when(k, F.col(c)).alias("v")) for c, k in wanted.items()]
        any_of = None
        for k in wanted.values():
            any_of = k if any_of is None else any_of | k
        # at most collect_limit values
        rows = wide.where(any_of).select(F.inline(F.array(*pairs))).where(F.col("v").isNotNull()).toPandas()
        values = {c: np.sort(g["v"].to_numpy(dtype=np.float64)) for c, g in rows.groupby("c")}
        for t in pending:
            held = values[t.column]
            t.value = float(held[int(np.searchsorted(held, t.lo, side="left")) + (t.rank - t.below)])


def _halves(t: _Target) -> tuple[float, float]:
    """The lower half of a window, by the doubles in it rather than by their distance: 64 halvings end at one value."""
    lo, hi = (_ordered(x) for x in (t.lo, t.hi))
    return t.lo, _double((lo + hi) // 2)


def _ordered(x: float) -> int:
    """An integer that orders as the doubles do."""
    bits = int(np.float64(x).view(np.int64))
    return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)


def _double(n: int) -> float:
    return float(np.int64(n).view(np.float64)) if n >= 0 else -float(np.int64(-n).view(np.float64))


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], collect_limit: int = COLLECT_LIMIT,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Long form ``(column, p, value)``; NULL value for a column with no data."""
    cols = list(cols)
    wide = df.select(*[value_column(c).alias(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        row = wide.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
        targets: dict[tuple[str, int], _Target] = {}
        plan = []
        for c in cols:
            for p in probs:
                if not row[c]:
                    plan.append((c, float(p), None))
                    continue
                h = float(p) * (row[c] - 1)
                lo = math.floor(h)
                hi = min(lo + 1, row[c] - 1)
                plan.append((c, float(p), (lo, hi, h - lo)))
                for rank in (lo, hi):
                    targets.setdefault((c, rank), _Target(c, rank, row[c]))
        order_statistics(wide, list(targets.values()), collect_limit, accuracy)
    finally:
        wide.unpersist()
    rows = []
    for c, p, spec in plan:
        if spec is None:
            rows.append((c, p, None))
        else:
            a, b = targets[(c, spec[0])].value, targets[(c, spec[1])].value
            rows.append((c, p, a + spec[2] * (b - a)))
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")
