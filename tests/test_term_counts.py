"""Terms are added up by batch before the aggregation: one row per term and batch, not one per token."""

from __future__ import annotations

from collections import Counter

from tablewright.operators import text

ROWS = [(1, ["a", "bb", "bb", None, "ccc"]), (1, ["bb"]), (None, []), (2, None), (3, ["ééé", "é", "bb", "ééé", ""])]


def test_counts_and_documents_of_each_term(spark):
    df = spark.createDataFrame(ROWS, "doc_id int, tokens array<string>")
    n, docs = Counter(), Counter()
    for _, tokens in ROWS:
        held = [t for t in tokens or [] if t is not None]
        n.update(held)
        docs.update(set(held))
    for least in (0, 2):
        got = {r["term"]: (r["n"], r["docs"]) for r in text._terms(df.repartition(3), "tokens", least).collect()}
        assert got == {t: (n[t], docs[t]) for t in n if len(t) >= least}


def test_tokens_are_not_exploded(spark):
    df = spark.createDataFrame(ROWS, "doc_id int, tokens array<string>")
    for made in (text._terms(df, "tokens", 2), text.build_vocabulary(df, "tokens")):
        assert "Generate explode" not in made._jdf.queryExecution().optimizedPlan().toString()
    vocab = text.count_vectorize(df, "doc_id", "tokens", min_df=1, max_df=10).collect()
    assert [(r["term"], r["term_count"], r["doc_freq"]) for r in vocab] == [("bb", 4, 3), ("ccc", 1, 1), ("ééé", 2, 1)]
