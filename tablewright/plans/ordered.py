"""Order-dependent computations without a single-task window.

``row_number() over (order by x)`` and ``sum(v) over (order by x)`` without a
``PARTITION BY`` (or partitioned by a handful of huge groups such as class
labels) make Spark move every row into one task.  The helpers here compute
the same values in three distributed steps:

1. range-partition on (groups, order) into ``n`` partitions and sort inside
   each partition, so a hot group is spread over many partitions;
2. aggregate per (partition, group) into a table of at most ``n + groups``
   rows and turn it into exclusive offsets (a window over that small table);
3. join the offsets (broadcast when there are at most ``MAX_BROADCAST_ROWS``,
   by a shuffle beyond) and add each row's position / running sum inside its
   partition.

The order must be total (append a unique key) so that positions do not
depend on the order in which shuffle blocks arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import ensure_checkpoint_dir

PID = "_tw_pid"
IDX = "_tw_idx"
MAX_BROADCAST_ROWS = 100_000


def _sort_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in order]


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return int(n)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _renamed(offsets: DataFrame, cols: Sequence[str], rows: int) -> DataFrame:
    """Give the small side its own column names so the self-join is unambiguous."""
    out = offsets.withColumnRenamed(PID, "_tw_rpid")
    for i, c in enumerate(cols):
        out = out.withColumnRenamed(c, f"_tw_g{i}")
    return F.broadcast(out) if rows <= MAX_BROADCAST_ROWS else out


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    cond = left[PID] == right["_tw_rpid"]
    for i, c in enumerate(cols):
        cond = cond & left[c].eqNullSafe(right[f"_tw_g{i}"])
    return cond


def _ranged(df: DataFrame, order: Sequence[str | Column], partition_by: Sequence[str], n: int | None) -> DataFrame:
    """Range-partitioned, sorted rows tagged with (partition id, position), written once.

    The tagged rows are materialised with a reliable ``checkpoint()`` (in
    the session's shared checkpoint folder), so the offsets branch and the
    rows branch read identical partitions even if the range bounds would be
    re-sampled differently or an executor is lost mid-query.
    """
    spec = [F.col(c).asc() for c in partition_by] + _sort_cols(order)
    ensure_checkpoint_dir(df.sparkSession)
    tagged = (
        df.repartitionByRange(_num_partitions(df, n), *spec)
        .sortWithinPartitions(*spec)
        .withColumn(PID, F.spark_partition_id())
        .withColumn(IDX, F.monotonically_increasing_id())
    )
    return tagged.checkpoint(eager=True)


def ordinal(
    df: DataFrame,
    order: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    out: str = "rn",
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact 1-based ``row_number() over (partition by .. order by ..)``."""
    partition_by = list(partition_by)
    ranged = _ranged(df, order, partition_by, num_partitions)
    stats = ranged.groupBy(PID, *partition_by).agg(
        F.min(IDX).alias("_tw_first"), F.count(F.lit(1)).alias("_tw_cnt")
    )
    w = Window.partitionBy(*partition_by).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_tw_off", F.coalesce(F.sum("_tw_cnt").over(w), F.lit(0))).drop("_tw_cnt")
    offsets = _renamed(offsets, partition_by, stats.count() if partition_by else 0)
    joined = ranged.join(offsets, _null_safe_on(ranged, offsets, partition_by), "inner")
    rn = (offsets["_tw_off"] + (ranged[IDX] - offsets["_tw_first"]) + F.lit(1)).alias(out)
    return joined.select(*[ranged[c] for c in df.columns], rn)


def prefix_sum(
    df: DataFrame,
    order: Sequence[str | Column],
    values: Sequence[str],
    partition_by: Sequence[str] = (),
    prefix: str = "cum_",
    exclusive: bool = False,
    num_partitions: int | None = None,
    total_prefix: str | None = None,
) -> DataFrame:
    """Running sums ``sum(v) over (partition by .. order by .. rows unbounded preceding)``.

    ``exclusive=True`` gives the sum of the rows strictly before each row;
    ``total_prefix`` also adds each group's total, from the same partition totals.
    Inside a partition the running sum is a NumPy ``cumsum`` on Arrow batches
    (the partition is already sorted), with one scalar carried between batches.
    """
    partition_by = list(partition_by)
    values = list(values)
    ranged = _ranged(df, order, partition_by, num_partitions)

    sums = ranged.groupBy(PID, *partition_by).agg(*[F.sum(v).alias(f"_tw_t_{v}") for v in values])
    group = Window.partitionBy(*partition_by)
    before = group.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        PID, *partition_by,
        *[F.coalesce(F.sum(f"_tw_t_{v}").over(before), F.lit(0)).alias(f"_tw_o_{v}") for v in values],
        *[F.coalesce(F.sum(f"_tw_t_{v}").over(group), F.lit(0)).alias(f"_tw_a_{v}") for v in values if total_prefix],
    )

    fields = {f.name: f.dataType for f in ranged.schema.fields}
    kinds = {v: fields[v] if isinstance(fields[v], (T.LongType, T.DoubleType)) else T.DoubleType() for v in values}
    out_schema = T.StructType(list(ranged.schema.fields) + [T.StructField(f"_tw_l_{v}", kinds[v]) for v in values])

    def local_cumsum(batches):
        # rows arrive sorted, so groups are contiguous; carry is the running sum of the last group so far
        last, carry = None, dict.fromkeys(values, 0)
        for pdf in batches:
            n = len(pdf)
            starts = np.zeros(n, bool)
            if n:
                keys = [pdf[c].to_numpy(dtype=object) for c in partition_by]
                for k in keys:
                    starts[1:] |= _differ(k[1:], k[:-1])
                first = tuple(k[0] for k in keys)
                starts[0] = last is None or any(_differ(np.array([a], object), np.array([b], object))[0] for a, b in zip(first, last))
                last = tuple(k[-1] for k in keys)
            segment = np.cumsum(starts)
            out = {}
            for v in values:
                whole = kinds[v].typeName() == "long"
                x = pdf[v].fillna(0).to_numpy(dtype=np.int64 if whole else np.float64)
                running = np.cumsum(x)
                # what had been summed up before each row's group began in this batch
                base = np.concatenate(([-carry[v]], (running - x)[starts])) if n else np.zeros(1, x.dtype)
                held = running - base[segment]
                if n:
                    carry[v] = held[-1]
                out[f"_tw_l_{v}"] = held - x if exclusive else held
            yield pdf.assign(**out)

    local = ranged.mapInPandas(local_cumsum, out_schema)
    offsets = _renamed(offsets, partition_by, sums.count() if partition_by else 0)
    joined = local.join(offsets, _null_safe_on(local, offsets, partition_by), "inner")
    cums = [(offsets[f"_tw_o_{v}"] + local[f"_tw_l_{v}"]).alias(f"{prefix}{v}") for v in values]
    totals = [offsets[f"_tw_a_{v}"].alias(f"{total_prefix}{v}") for v in values if total_prefix]
    return joined.select(*[local[c] for c in df.columns], *cums, *totals)


def following(
    df: DataFrame,
    order: Sequence[str | Column],
    values: dict[str, Column],
    partition_by: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Add each row's ``values`` of the row behind it: ``lead(v) over (partition by .. order by ..)`` for any group size.

    Inside a range of the order it is a window over the range; the last row of a range takes the first row of the
    next range that has rows, from a table of one row per range (broadcast while that is small).  NULL behind a
    group's last row.
    """
    partition_by = list(partition_by)
    group = F.struct(*partition_by, F.lit(0).alias("_tw_one"))
    held = F.struct(group.alias("g"), *[v.alias(k) for k, v in values.items()])
    ranged = _ranged(df.withColumn("_tw_v", held), order, partition_by, num_partitions)
    inside = Window.partitionBy(PID).orderBy(IDX)
    local = ranged.withColumn("_tw_next", F.lead("_tw_v").over(inside))
    edges = ranged.groupBy(PID).agg(F.min_by("_tw_v", IDX).alias("_tw_edge"))
    edges = edges.select(PID, F.lead("_tw_edge").over(Window.orderBy(PID)).alias("_tw_edge"))
    edges = _renamed(edges, [], edges.count())
    joined = local.join(edges, local[PID] == edges["_tw_rpid"], "inner")
    behind = F.coalesce("_tw_next", "_tw_edge")
    same = behind["g"].eqNullSafe(F.col("_tw_v")["g"])
    return joined.select(*[local[c] for c in df.columns], *[F.when(same, behind[k]).alias(k) for k in values])


def _differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Element-wise inequality in which two missing values are equal."""
    return ~((a == b) | (pd.isna(a) & pd.isna(b)))


def hash_ordinal(
    df: DataFrame,
    hash_col: str,
    tiebreak: Sequence[str],
    partition_by: Sequence[str] = (),
    out: str = "rn",
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """``row_number() over (partition by .. order by hash_col, tiebreak..)`` for a uniform 32-bit hash.

    A uniform hash needs no sampled range bounds: ``floor(h * B / 2^32)`` is
    already an order-preserving bucket, and every bucket holds about
    ``n / B`` rows of each group, however large the group.  Positions are a
    window per (group, bucket) plus the row counts of the earlier buckets of
    the same group (at most ``groups * B`` rows: broadcast while that is small,
    joined by a shuffle on (group, bucket) beyond).  Everything is a
    deterministic function of the data, so no checkpoint is needed.
    """
    partition_by = list(partition_by)
    n = df.count()
    buckets = max(_num_partitions(df, None), -(-n // rows_per_bucket))
    b = F.floor(F.col(hash_col).cast("double") * F.lit(float(buckets)) / F.lit(4294967296.0)).cast("long")
    tagged = df.withColumn("_tw_b", b)
    w = Window.partitionBy(*partition_by, "_tw_b").orderBy(hash_col, *tiebreak)
    local = tagged.withColumn("_tw_lrn", F.row_number().over(w))
    counts = tagged.groupBy(*partition_by, "_tw_b").agg(F.count(F.lit(1)).alias("_tw_cnt"))
    wo = Window.partitionBy(*partition_by).orderBy("_tw_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*partition_by, "_tw_b", F.coalesce(F.sum("_tw_cnt").over(wo), F.lit(0)).alias("_tw_off"))
    offsets = offsets.withColumnRenamed("_tw_b", "_tw_rb")
    for i, c in enumerate(partition_by):
        offsets = offsets.withColumnRenamed(c, f"_tw_g{i}")
    if (counts.count() if partition_by else buckets) <= MAX_BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    cond = local["_tw_b"] == offsets["_tw_rb"]
    for i, c in enumerate(partition_by):
        cond = cond & local[c].eqNullSafe(offsets[f"_tw_g{i}"])
    joined = local.join(offsets, cond, "inner")
    return joined.select(*[local[c] for c in df.columns], (offsets["_tw_off"] + local["_tw_lrn"]).alias(out))


def hash_top_n(df: DataFrame, hash_col: str, tiebreak: Sequence[str], n: int, slack: float = 1.2) -> DataFrame:
    """The ``n`` rows with the smallest uniform 32-bit hash, without a global top-n merge.

    ``orderBy(h).limit(n)`` keeps ``n`` rows per partition and merges all of
    them in one task.  A map-side filter ``h < t`` with ``t`` chosen for about
    ``slack * n`` survivors (raised until at least ``n`` survive) leaves a
    bounded set, on which the exact top-n is then taken.
    """
    total = df.count()
    if total <= n:
        return df
    frac = min(1.0, slack * n / total + 64.0 / total)
    while True:
        t = int(frac * 4294967296.0)
        kept = df.filter(F.col(hash_col) < F.lit(t))
        if frac >= 1.0 or kept.count() >= n:
            break
        frac = min(1.0, frac * 2)
    return kept.orderBy(hash_col, *tiebreak).limit(int(n))
