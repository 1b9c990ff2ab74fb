import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL
from odd import no_documents, odd_documents, saved
from pyspark.sql import functions as F

from tablewright.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(docs, min_docs=3, top=200):
    counts, docs_with, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs_with[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs_with[lang].items() if n >= min_docs]
        sources = [s for la, s in groups if la == lang]

        def rates(held, kept=kept):
            total = sum(held[t] for t in kept)
            return {t: 1 + 10**9 * (held[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: rates(counts[lang, s]) for s in sources}
        q = rates(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", terms)):
                rows.sort(key=lambda r: (-r[1], r[0].encode()))
                rows = rows if part == "pair" else rows[:top]
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(rows, 1)}
    return out


def held(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("lang", "source", "text").collect()
    assert held(dv.op12_source_divergence(spark, SF_SMALL)) == plain([tuple(r) for r in docs])


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    docs = [tuple(r) for r in df.select("lang", "source", "text").collect()]
    assert held(dv.op12_source_divergence(spark, saved(df, tmp_path))) == plain(docs)
    assert dv.diverging(no_documents(spark)).count() == 0


@pytest.mark.parametrize("limits", [{}, {"BLOCK_SOURCES": 2, "BLOCK_CELLS": 7, "MAX_GROUPS": 3}, {"HELD_ROWS": 2, "BLOCK_BYTES": 40}])
def test_many_sources_in_blocks(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(dv, name, value)
    rng = np.random.default_rng(3)
    docs = [(["en", "de", None, "xx"][i % 4], f"s{rng.integers(7)}", " ".join(f"w{'abcdefgh'[x]}" for x in rng.integers(0, 8, 12)))
            for i in range(120)]
    docs += [("none", "a", "1 2 3"), ("none", "b", None), ("one", "c", "Z z Z"), ("en", "empty", "")]
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(4)
    found = held(dv.diverging(df, min_docs=2, top=3))
    assert found == plain(docs, 2, 3)
    assert ("none", "a", "pair", "b", 0, 1) in found


def test_a_terms_rows_may_end_in_the_next_batch(spark, monkeypatch):
    monkeypatch.setattr(dv, "BLOCK_CELLS", 5)
    docs = [("en", f"s{i % 5}", f"{'abcdef'[i % 6]} {'xyz'[i % 3]} same") for i in range(60)]
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(3)
    assert held(dv.diverging(df)) == plain(docs)


def test_rates_are_exact(spark):
    cases = [(1, 3), (10**15, 10**15), (123_456_789_012_345, 987_654_321_098_765), (7, 9 * 10**15)]
    want = [1 + 10**9 * c // t for c, t in cases]
    counts, totals = (np.array(x, np.int64) for x in zip(*cases))
    assert dv.rates(counts, totals).tolist() == want
    df = spark.createDataFrame(cases, "c long, t long")
    assert [r[0] for r in df.select(dv.rate(F.col("c"), F.col("t"))).collect()] == want


def test_counts_of_a_block():
    block = pa.table({"lang": ["a", "a", "b"], "source": ["x", "x", ""], "text": ["Ab ab, É1é", "AB", "..."]})
    rows = {tuple(r.values()) for r in dv.term_counts(block).to_pylist()}
    assert rows == {("a", "x", "ab", 3, 2), ("a", "x", "É", 1, 1), ("a", "x", "é", 1, 1), ("a", "x", None, 0, 0), ("b", "", None, 0, 0)}
