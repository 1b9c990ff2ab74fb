"""Connected components of an edge table, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id in ``edges`` (columns a, b): root is the smallest id of its component.

    Each round takes the smallest label among the neighbours, then jumps to the label's label, so the number of
    rounds grows with the logarithm of a component's diameter.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut(edges.where(F.col("a") != F.col("b")).select(F.inline(ways)).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select(
        "id", F.least("id", "m").alias("root")))
    for _ in range(MAX_ROUNDS):
        near = both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("n")).agg(F.min("root").alias("m"))
        low = labels.join(near, labels.id == near.n).select("id", "root", F.least("root", "m").alias("low"))
        jump = labels.select(F.col("id").alias("j"), F.col("root").alias("far"))
        new = cut(low.join(jump, F.col("low") == F.col("j")).select(
            "id", F.least("low", "far").alias("root"), (F.least("low", "far") != F.col("root")).alias("moved")))
        moved = new.where("moved").limit(1).count()
        labels = new.select("id", "root")
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
