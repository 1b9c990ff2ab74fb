"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target of words: a share by weight of all words to take, at most ``most`` times its own size, the
excess shared out again among the others.  Complete epochs come first: a target of 1.4 sizes takes every document once.
What is left is a sample without replacement in which a document's chance grows with its quality: its key is
``-ln(u) / weight`` with ``u`` drawn from a hash, keys are sorted within the source, and the documents whose running
sum of words stays within the budget are taken.

A document that would pass the budget is left out; where the gap it leaves is more than ``NEAR`` of the target, the
documents behind it that fit are summed up again in the same order, until none fits; one last document may go beyond
the target where that comes nearer to it.  Sorting and running sums are
``plans.ordered.prefix_sum``: a source of any size is spread over many tasks, and only the narrow rows
(id, source, size, key) are sorted, never texts.  Targets are found by a few small aggregations over the table of
sources, which may have any number of rows.

Nulls: a null text has no words and is never taken; null sources form one source, the last one.  Equal rows are
counted before they are shuffled; each copy draws its own key.  Documents without words are in the result with 0
taken; sources without words get a target of 0; an empty table gives no rows; other columns are ignored.  Keys are
functions of the rows, so reruns agree under any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import cut, documents, expand
from tablewright.plans.joins import lookup_join
from tablewright.plans.ordered import ordinal, prefix_sum

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
NEAR = 0.001
SEED = 13
LEAST_QUALITY = 0.05
JUNK = "#*$%&|<>{}[]\\^~_=+@0123456789"


def words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text."""
    marks = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """A document's weight: the share of bytes that aren't junk times the share of lines that are new, above 0."""
    clean = F.octet_length(F.translate(text, JUNK, "")) / F.greatest(F.octet_length(text), F.lit(1))
    lines = F.split(text, "\n")
    fresh = F.size(F.array_distinct(lines)) / F.size(lines)
    return F.greatest(F.coalesce(clean * fresh, F.lit(0.0)), F.lit(LEAST_QUALITY))


def _named(source: Column) -> Column:
    """The source as a join key in which null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size); weights repeat in the sources' order, null last."""
    ranked = ordinal(sizes, [F.col("source").asc_nulls_last()], out="_rank")
    place = F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")
    ranked = cut(ranked.withColumn("_w", F.array(*[F.lit(float(w)) for w in weights])[place]))
    most_of = F.col("source_size") * F.lit(float(most))
    size, weight = ranked.agg(F.sum("source_size"), F.sum("_w")).first()
    # the common level of target / weight rises until no target is above its source's most
    level = share * size / weight if size else 0.0
    while size:
        full = most_of <= F.col("_w") * F.lit(level)
        used, open_ = ranked.agg(F.sum(F.when(full, most_of)), F.sum(F.when(~full, F.col("_w")))).first()
        higher = (share * size - (used or 0.0)) / open_ if open_ else math.inf
        if higher <= level or not open_:
            break
        level = higher
    target = F.least(F.col("_w") * F.lit(float(level)), most_of)
    return cut(ranked.select("source", "source_size", target.alias("target")))


def mix(
    df: DataFrame, doc: str = "doc_id", source: str = "source", text: str = "text", weight: Column | None = None,
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED,
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, epochs (whole times taken), taken (words), weight, key."""
    body = F.col(text)
    rows = df.select(
        F.col(doc).alias("doc_id"), F.col(source).cast("string").alias("source"), words(body).alias("size"),
        (quality(body) if weight is None else weight.cast("double")).alias("weight"), F.xxhash64(body).alias("mark"),
    )
    names = rows.columns
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).select("*", F.lit(0).cast("long").alias("_start"))
    # narrow rows, read for the sizes and for the draw: texts are read once
    rows = cut(expand(counted, names, "copy"))
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goal = goal.select(_named(F.col("source")).alias("_goal"), "source_size", "target")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "mark", "copy"), 11).cast("double") + 0.5) / float(1 << 53)
    rows = rows.withColumn("key", -F.log(u) / F.greatest(F.col("weight"), F.lit(1e-9)))
    rows = lookup_join(rows, goal, _named(F.col("source")), "_goal", "inner").drop("_goal")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rows = rows.withColumn("epochs", whole)
    rows = cut(rows.withColumn("left", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")))
    held = rows.columns
    going = (F.col("left") >= 1) & (F.col("size") > 0) & (F.col("size") <= F.col("left"))
    out, state = rows.where(~going), rows.where(going)
    while not state.isEmpty():
        order = ["key", "doc_id", "mark", "copy"]
        placed = cut(prefix_sum(state, order, ["size"], ["source"], exclusive=True))
        fits = F.col("cum_size") + F.col("size") <= F.col("left")
        sums = placed.groupBy(_named(F.col("source")).alias("_gap")).agg(F.sum(F.when(fits, F.col("size"))).alias("_used"))
        placed = lookup_join(placed, cut(sums), _named(F.col("source")), "_gap", "inner")
        gap = F.col("left") - F.coalesce("_used", F.lit(0))
        placed = placed.select(
            *[c for c in held if c not in ("epochs", "left")], (F.col("epochs") + fits.cast("long")).alias("epochs"),
            gap.alias("left"), (~fits & (F.col("size") <= gap) & (gap > F.col("target") * NEAR)).alias("_again"),
        )
        placed = cut(placed)
        out = out.unionByName(placed.where(~F.col("_again")).drop("_again"))
        state = placed.where("_again").select(*held)
    taken = (F.col("epochs") * F.col("size")).alias("taken")
    return _nearer(out).select("doc_id", "source", "size", "source_size", "target", "epochs", taken, "weight", "key")


def _nearer(out: DataFrame) -> DataFrame:
    """Take one more document, the smallest one left, in sources that this brings nearer to their target."""
    which = ["size", "key", "doc_id", "mark", "copy"]
    whole = F.floor(F.col("target") / F.col("source_size"))
    spare = (F.col("size") > 0) & (F.col("epochs") == whole)
    sums = out.groupBy(_named(F.col("source")).alias("_near")).agg(
        (F.max("target") - F.sum(F.col("epochs") * F.col("size"))).alias("_gap"),
        F.min(F.when(spare, F.struct(*which))).alias("_one"),
    )
    sums = cut(sums.select("_near", F.when(F.col("_one.size") < 2 * F.col("_gap"), F.col("_one")).alias("_one")))
    near = lookup_join(out, sums, _named(F.col("source")), "_near", "inner")
    more = F.struct(*which).eqNullSafe(F.col("_one"))
    return near.withColumn("epochs", F.col("epochs") + more.cast("long"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 150 % of their words."""
    return mix(documents(spark, sf_dir))
