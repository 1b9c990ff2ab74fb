"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A text's tokens are runs of letters and digits and runs of other characters; a token equal to the one before it is
written as a back reference.  Unigrams and bigrams are hashed to ``2**BITS`` places, their counts damped (log) and
scaled to unit length.  At most ``TRAIN_ROWS`` labelled rows, chosen by hash of the id from all of them, train the
model in groups of about ``SHARD_ROWS``: each runs FTRL-proximal updates over its rows (the rarer label weighs more),
and a place's weight is averaged over the groups that met it.
Scores are sparse dot products through the logistic function.

Nulls: a null text is empty and scores by the intercept alone; null labels and null ids are not learned from; an id
labelled several times takes its largest label.  Repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from tablewright.llm.common import WordHash, crc_column, cut, documents, mix, scan, utf8
from tablewright.llm.quality_rules import pieces

BITS = 18
TRAIN_ROWS = 24_000
SHARD_ROWS = 1500
EPOCHS = 6
FTRL_ALPHA, FTRL_BETA, L1, L2 = 1.0, 1.0, 0.2, 0.5
THRESHOLD = 0.3
SCALE = 8.0
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
SAME = 0x51ED270B76E0C1A5


def features(body: bytes, hashes: WordHash, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text's n-grams; place 0 is the intercept."""
    parts, last = [], None
    for piece in pieces(body):
        h = hashes.array(TOKEN.findall(piece))
        if not len(h):
            continue
        before = np.concatenate((h[:1] if last is None else [last], h[:-1])).astype(np.uint64)
        same = h == before
        if last is None:
            same[0] = False
        last = h[-1]
        one = np.where(same, np.uint64(SAME), h)
        two = mix(before * np.uint64(3) + one)
        parts += [one, two[1:] if len(parts) == 0 else two]
    if not parts:
        return np.zeros(1, np.int32), np.full(1, 1.0, np.float32)
    place = (mix(np.concatenate(parts)) >> np.uint64(64 - bits)).astype(np.int64)
    place, count = np.unique(np.maximum(place, 1), return_counts=True)
    value = 1 + np.log(count)
    value *= SCALE / np.sqrt((value * value).sum())
    return np.concatenate(([0], place)).astype(np.int32), np.concatenate(([1.0], value)).astype(np.float32)


def ftrl(
    rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int = BITS, epochs: int = EPOCHS
) -> tuple[np.ndarray, np.ndarray]:
    """(places met, their weights) after ``epochs`` passes of FTRL-proximal updates."""
    good = sum(r[0] > 0 for r in rows)
    ratio = np.sqrt(max(good, 1) / max(len(rows) - good, 1))
    cost = (max(1.0, ratio), max(1.0, 1 / ratio))
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(i: np.ndarray) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * L1) / ((FTRL_BETA + np.sqrt(n[i])) / FTRL_ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    order = np.random.default_rng(5)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            label, i, x = rows[r]
            w = weights(i)
            g = cost[int(label > 0)] * (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / FTRL_ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    met = np.flatnonzero(n)
    return met, weights(met)


def learn(
    df: DataFrame, labels: DataFrame, label: str = "quality", doc: str = "doc_id", text: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> np.ndarray:
    """Weights learned from at most ``train_rows`` labelled rows of ``df``."""
    held = labels.where(F.col(doc).isNotNull() & F.col(label).isNotNull())
    held = held.groupBy(F.col(doc).alias("_id")).agg(F.max(label).alias("_label"))
    # at most train_rows narrow rows
    held = cut(held.orderBy(F.xxhash64("_id"), "_id").limit(train_rows))
    shards = max(1, -(-held.count() // SHARD_ROWS))
    held = held.withColumn("_shard", F.pmod(F.xxhash64(F.lit(1), "_id"), F.lit(shards)).cast("long"))
    bodies = df.select(F.col(doc).alias("_id"), utf8(text).alias("body")).join(F.broadcast(held), "_id")

    def make() -> Callable:
        hashes = WordHash()

        def work(columns: list) -> list[tuple]:
            return [
                (int(y > 0), i.tolist(), x.tolist(), shard)
                for y, shard, (i, x) in ((y, k, features(b, hashes)) for b, y, k in zip(*columns))
            ]

        return work

    schema = StructType([
        StructField("label", LongType()), StructField("i", ArrayType(IntegerType())),
        StructField("x", ArrayType(FloatType())), StructField("shard", LongType()),
    ])
    rows = scan(bodies.select("body", "_label", "_shard"), make, schema, rows=500)

    def fit(table: pa.Table) -> pa.Table:
        i, x = table["i"].to_pylist(), table["x"].to_pylist()
        rows = [(y, np.array(a, np.int64), np.array(b)) for y, a, b in zip(table["label"].to_pylist(), i, x)]
        rows.sort(key=lambda r: (len(r[1]), r[1].tolist(), r[0]))
        at, w = ftrl(rows)
        return pa.table({"i": pa.array(at, pa.int64()), "w": pa.array(w, pa.float64())})

    out = StructType([StructField("i", LongType()), StructField("w", DoubleType())])
    fitted = rows.groupBy("shard").applyInArrow(fit, out)
    # at most 2**BITS rows
    got = fitted.groupBy("i").agg(F.avg("w").alias("w")).toArrow()
    w = np.zeros(1 << BITS, np.float32)
    w[got["i"].to_numpy()] = got["w"].to_numpy()
    return w


def score(df: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with the score."""
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def make() -> Callable:
        hashes, w = WordHash(), sent.value

        def work(columns: list) -> list[tuple]:
            out = []
            for *row, body in zip(*columns):
                i, x = features(body, hashes)
                out.append((*row, float(1 / (1 + np.exp(-np.clip(float(w[i] @ x), -35, 35))))))
            return out

        return work

    schema = StructType([*(df.schema[c] for c in keep), StructField("score", DoubleType())])
    return scan(df.select(*keep, utf8(text).alias("_body")), make, schema)


def held_out(doc: str = "doc_id") -> Column:
    return crc_column(doc) % 5 == 0


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learned from labelled rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", held_out().alias("held_out"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score(docs, learn(docs, labels), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
