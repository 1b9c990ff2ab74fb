"""A row is a document, whatever its id, at every size of the vocabulary."""

import math
from collections import Counter

import pytest

from tablewright.operators import text

DOCS = [
    (1, ["a", "b", "a", "rare"]), (1, ["b", "c"]), (None, ["a", "c", "c", "unseen"]), (None, []), (2, None),
    (3, ["a", None, "b", "b"]), (3, ["a", None, "b", "b"]), (4, ["long" * 100, "a", "d", "e", "f"]),
]
VOCAB = {"a": 9, "b": 7, "c": 5, "d": 4, "e": 4, "f": 3, "rare": 2, "long" * 100: 2}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, tokens array<string>").repartition(3)


@pytest.fixture(params=[100_000, 3, 0], ids=["all hot", "three hot", "all cold"])
def hot(request, monkeypatch):
    monkeypatch.setattr(text, "HOT_TERMS", request.param)


def test_tfidf(spark, docs, hot):
    vocab = spark.createDataFrame(list(VOCAB.items()), "term string, doc_freq long")
    want = []
    for doc, tokens in DOCS:
        w = {t: n * (math.log(11 / (1 + VOCAB[t])) + 1) for t, n in Counter(tokens or []).items() if t in VOCAB}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want += [(str(doc), t, round(x / norm, 9)) for t, x in w.items()]
    found = text.tfidf(docs, "id", "tokens", vocab, 10).collect()
    assert sorted((str(r.id), r.term, round(r.weight, 9)) for r in found) == sorted(want)


def test_encode_sequence(spark, docs, hot):
    ids = {t: i for i, t in enumerate(VOCAB, 2)}
    vocab = spark.createDataFrame(list(ids.items()), "term string, term_id long")
    want = [(str(d), [ids.get(t, 1) for t in tokens or [] if t is not None]) for d, tokens in DOCS]
    found = text.encode_sequence(docs, "id", "tokens", vocab).collect()
    assert sorted((str(r.id), r.seq) for r in found) == sorted(want)
    found = text.encode_sequence(docs, "id", "tokens", vocab, last=2).collect()
    assert sorted((str(r.id), r.seq) for r in found) == sorted((d, s[-2:]) for d, s in want)


def test_vocabulary_reaches_the_model_whole(spark):
    rows = [(i, [f"w{j}" for j in range(i % 7 + 1)] + ["x\ny", "\x01"]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    model, vocab = text.encode_text_model(df, "id", "tokens", max_df=1.0, min_df=1, min_len=1)
    terms = [r.term for r in vocab.orderBy("term_index").collect()]
    assert model.stages[0].vocabulary == terms and "x\ny" in terms
    with pytest.raises(ValueError):
        text.encode_text_model(df.limit(0), "id", "tokens")
