"""The raw text is in none of the rows that cleaning writes on its way, unless it is asked for."""

from __future__ import annotations

from tablewright.operators import text


def test_the_text_is_not_written_with_the_tokens(spark, monkeypatch):
    df = spark.createDataFrame([(1, "Running dogs don't run 3 times"), (2, ""), (2, "Dogs")], "doc_id long, text string")
    whole = text.clean_text(df, "text", "tokens")
    written, kind = [], type(df)
    checkpoint = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **kw: (written.append(self.columns), checkpoint(self, *a, **kw))[1])
    lean = text.clean_text(df, "text", "tokens", keep_text=False)
    assert lean.columns == ["doc_id", "tokens"] and not any("text" in c for c in written)
    assert ["doc_id", "tokens"] in written
    tokens = [sorted(map(str, d.select("doc_id", "tokens").where("tokens is not null").collect())) for d in (whole, lean)]
    assert tokens[0] == tokens[1]
