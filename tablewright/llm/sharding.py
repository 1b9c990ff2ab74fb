"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A key descends region -> rack -> shard.  At each level every child draws the
score ``-ln(u) / weight`` from a hash ``u`` of (key, child) and the smallest
score wins, so a child is chosen in proportion to its weight, and a change of
weight moves keys only into or out of the subtree that changed.  A shard added
beyond the first ``base`` ones opens a region of its own: it takes keys from
every old shard and moves none between old shards.

Nulls: a null key counts as the empty key; a null text has no bytes.  Repeated
rows share a shard and get slots of their own.  Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cut, documents, expand

SLOT_BUCKETS = 1024


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(n_shards: int, base: int = 24, racks: int = 4, per_rack: int = 2) -> list[Leaf]:
    """Shards 0..n-1: the first ``base`` fill racks and regions evenly, each later one is a region of its own."""
    leaves = []
    for s in range(n_shards):
        if s < base:
            leaves.append(Leaf(s // (racks * per_rack), s // per_rack % racks, s))
        else:
            leaves.append(Leaf(-(-base // (racks * per_rack)) + s - base, 0, s))
    return leaves


def _draw(key: Column, children: list[tuple[str, int, float]]) -> Column:
    """The child (name, id, weight) of the smallest weighted score."""
    if len(children) == 1:
        return F.lit(children[0][1])
    scored = []
    for name, child, weight in children:
        head = F.conv(F.substring(F.md5(F.concat_ws("|", key, F.lit(name)).cast("binary")), 1, 8), 16, 10)
        score = -F.log((head.cast("double") + 0.5) / 4294967296.0) / weight
        scored.append(F.struct(score.alias("score"), F.lit(child).alias("child")))
    return F.array_min(F.array(*scored))["child"]


def descend(key: Column, leaves: list[Leaf]) -> Column:
    """struct(region, rack, shard) of a key."""
    weight: dict[tuple, float] = defaultdict(float)
    children: dict[tuple, set] = defaultdict(set)
    for x in leaves:
        path = (x.region, x.rack, x.shard)
        for depth in range(3):
            weight[path[: depth + 1]] += x.weight
            children[path[:depth]].add(path[: depth + 1])

    def below(parent: tuple) -> Column:
        kids = sorted(children[parent])
        return _draw(key, [("/".join(map(str, k)), k[-1], weight[k]) for k in kids if weight[k] > 0])

    def choose(drawn: Column, options: list[tuple[int, Column]]) -> Column:
        out = None
        for value, column in options:
            out = F.when(drawn == value, column) if out is None else out.when(drawn == value, column)
        return out

    regions = sorted(k[0] for k in children[()])
    racks = {r: sorted(k[1] for k in children[(r,)]) for r in regions}
    return F.transform(
        F.array(below(())),
        lambda region: F.transform(
            F.array(choose(region, [(r, below((r,))) for r in regions])),
            lambda rack: F.struct(
                region.alias("region"),
                rack.alias("rack"),
                choose(region, [(r, choose(rack, [(k, below((r, k))) for k in racks[r]])) for r in regions]).alias("shard"),
            ),
        )[0],
    )[0]


def assign(df: DataFrame, leaves: list[Leaf], key: str = "doc_id", column: str = "place") -> DataFrame:
    """Add ``column``: struct(region, rack, shard).  Per row, without a shuffle."""
    return df.withColumn(column, descend(F.coalesce(F.col(key).cast("string"), F.lit("")), leaves))


def slots(df: DataFrame, group: str, order: list[str], n_groups: int, column: str = "slot") -> DataFrame:
    """Number the rows of each group from 0 without gaps, in the order (md5 of all order columns, order).

    ``df`` must hold nothing but ``group``, ``order`` and columns that these determine: equal rows are counted
    first and expanded at the end, so a row repeated any number of times never gathers in one task, and rows that
    share one id but differ in size or text spread over all buckets.
    """
    names = df.columns
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_h", F.md5(F.concat_ws("|", *parts).cast("binary")))
    head = F.conv(F.substring("_h", 1, 3), 16, 10).cast("int")
    # narrow rows, read twice below: the table is scanned once
    counted = cut(counted.withColumn("_bucket", F.floor(head * SLOT_BUCKETS / 4096).cast("int")))
    totals = counted.groupBy(F.col(group).alias("_g"), F.col("_bucket").alias("_b")).agg(F.sum("_n").alias("_t"))
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_g", "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    # at most n_groups * SLOT_BUCKETS rows, whatever the table holds
    offsets = F.broadcast(offsets) if n_groups <= 64 else offsets
    inside = Window.partitionBy(group, "_bucket").orderBy("_h", *order).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        offsets, (F.col(group) == F.col("_g")) & (F.col("_bucket") == F.col("_b"))
    )
    placed = placed.select(*names, (F.col("_before") + F.col("_inside")).alias("_start"), "_n")
    return expand(placed, names, column)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0..23, law ``key``; grown_shard is the shard when there are 25."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id", (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    rows = assign(assign(rows, layout(24)), layout(25), column="grown")
    rows = rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("place.region").alias("region"),
        F.col("place.rack").alias("rack"), F.col("place.shard").alias("shard"), F.col("grown.shard").alias("grown_shard"),
    )
    return slots(rows, "shard", ["doc_id", "text_crc32", "size"], 24)
