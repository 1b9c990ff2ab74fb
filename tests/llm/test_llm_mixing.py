import math
import re
from collections import defaultdict

import pytest
from conftest import SF_SMALL
from odd import TEXTS, no_documents, odd_documents, saved
from pyspark.sql import functions as F

from tablewright.llm import mixing as mx

WORD = re.compile("[^\x20\x09-\x0d]+")


def goals(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by resharing the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = dict.fromkeys(order, 0.0), set(order), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(w[s] for s in open_)
        for s in open_:
            out[s] += left * w[s] / total
        left = sum(max(0.0, out[s] - most * sizes[s]) for s in order)
        open_ = {s for s in open_ if out[s] < most * sizes[s]}
        for s in order:
            out[s] = min(out[s], most * sizes[s])
    return out


def check(rows, docs):
    sizes = defaultdict(int)
    for _, source, text in docs:
        sizes[source] += len(WORD.findall(text or ""))
    assert sorted(map(str, ((r.doc_id, r.source, r.size) for r in rows))) == sorted(
        map(str, ((d, s, len(WORD.findall(t or ""))) for d, s, t in docs)))
    target = goals(sizes)
    by_source = defaultdict(list)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], abs_tol=1e-6)
        assert r.taken == r.epochs * r.size and 0 <= r.taken <= 2 * r.size
        by_source[r.source].append(r)
    for source, held in by_source.items():
        if not sizes[source]:
            continue
        whole = math.floor(target[source] / sizes[source] + 1e-9)
        assert all(r.epochs in (whole, whole + 1) for r in held if r.size)
        gap = target[source] - sum(r.taken for r in held)
        rest = [r.size for r in held if r.size and r.epochs == whole]
        # within the tolerance, or nothing that is left would fit or come nearer
        near = mx.NEAR * target[source] + 1
        assert gap <= near or not rest or min(rest) >= 2 * gap
        assert gap >= -near or -gap < max(r.size for r in held if r.epochs > whole) / 2
        greedy(held, whole, math.floor(target[source] - whole * sizes[source]), target[source])
    return target


def greedy(held, whole, left, target):
    """One document after the other in the keys' order takes what prefix sums take, round by round."""
    state = sorted((r for r in held if 0 < r.size <= left), key=lambda r: (r.key, r.doc_id is not None, r.doc_id or 0))
    taken = set()
    while state and left >= 1:
        total, used = 0, 0
        for r in state:
            if total + r.size <= left:
                taken.add(id(r))
                used += r.size
            total += r.size
        left -= used
        state = [r for r in state if id(r) not in taken and r.size <= left] if left > mx.NEAR * target else []
    left += target % 1
    rest = [r for r in held if r.size and id(r) not in taken] if whole < 2 else []
    last = min(rest, key=lambda r: (r.size, r.key), default=None)
    if last is not None and last.size < 2 * left:
        taken.add(id(last))
    assert all((r.epochs == whole + 1) == (id(r) in taken) for r in held)


def test_given_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "text").collect()]
    rows = mx.op13_source_mixing(spark, SF_SMALL).collect()
    check(rows, docs)
    total = sum(r.size for r in rows)
    assert abs(sum(r.taken for r in rows) - 1.5 * total) < 0.02 * total
    again = mx.mix(spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(7)).collect()
    assert sorted((r.doc_id, r.taken, r.key) for r in again) == sorted((r.doc_id, r.taken, r.key) for r in rows)


def test_odd_documents(spark, tmp_path):
    docs = [(i, None, t) for i, t in TEXTS]
    check(mx.op13_source_mixing(spark, saved(odd_documents(spark), tmp_path)).collect(), docs)
    assert mx.mix(no_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, "b", " ")], "doc_id long, source string, text string")
    assert [(r.size, r.target, r.taken) for r in mx.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_copies_draw_keys_of_their_own(spark):
    docs = [(1, "hot", "one two three four five")] * 3000 + [(2, "b", "x " * 9000), (3, None, "y " * 12000), (4, "z", "z")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(3)
    rows = mx.mix(df).collect()
    check(rows, docs)
    hot = [r for r in rows if r.doc_id == 1]
    assert len({r.key for r in hot}) == 3000


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 300}, {"a": 0, "b": 7}, {f"s{i:03}": i * i % 97 for i in range(60)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    want = goals(sizes)
    assert {r.source: r.target for r in mx.targets(df).collect()} == pytest.approx(want)


def test_better_documents_are_likelier(spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("a b").alias("text"), F.when(F.col("id") % 3 == 0, 4.0).otherwise(1.0).alias("w"))
    rows = mx.mix(df, weight=F.col("w"), share=0.25).collect()
    good = [r.epochs for r in rows if r.doc_id % 3 == 0]
    rest = [r.epochs for r in rows if r.doc_id % 3]
    assert sum(good) + sum(rest) == 1500
    # 2000 documents of weight 4 and 4000 of weight 1, a quarter of all drawn: about half and an eighth of them
    assert 0.45 < sum(good) / len(good) < 0.58 and 0.09 < sum(rest) / len(rest) < 0.16
