"""Look-ups of terms beyond the hot ones go by blocks of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import text


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_exploded_for_cold_terms(spark, monkeypatch):
    monkeypatch.setattr(text, "HOT_TERMS", 2)
    monkeypatch.setattr(text, "BLOCK_ROWS", 3)
    rows = [(i if i % 4 else None, [f"runs{'x' * (i % 5)}", "the", f"going{i}", "walking", None] if i % 7 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(3)
    out = text.stem_tokens(df, "tokens", "stems")
    assert "Generate" not in _plan(out)  # a row with n terms would be n rows of a shuffle
    held = {(r["doc_id"], tuple(r["tokens"] or ())): r["stems"] for r in out.collect()}
    assert out.count() == 40
    assert held[(1, ("runsx", "the", "going1", "walking", None))] == ["runsx", "the", "going1", "walk", None]
    assert all((s is None) == (not t) for (_, t), s in held.items())


def test_stems_are_worked_out_once(spark, monkeypatch):
    """The chain stands in one written table, not in the filter and the sampled order as well."""
    seen, real = [], text.with_stem

    def with_stem(terms):
        seen.append(real(terms))
        return seen[-1]

    ranked = []
    order = text.ordinal
    monkeypatch.setattr(text, "with_stem", with_stem)
    monkeypatch.setattr(text, "ordinal", lambda df, *a, **k: ranked.append(df) or order(df, *a, **k))
    df = spark.createDataFrame([(1, ["walking", "walks", "tree"])], "doc_id long, tokens array<string>")
    assert text.stem_tokens(df, "tokens").select(F.array_join("tokens", " ")).first()[0] == "walk walk tree"
    assert len(seen) == 1 and "transform(" not in _plan(ranked[0])
