"""Stems as column expressions against a plain word-by-word Porter2, at every size of the vocabulary."""

import itertools
import random

import pytest
from plain_stemmer import stem_word

from tablewright.functions import stemming
from tablewright.operators import text

ROOTS = ["gener", "commun", "arsen", "hop", "happ", "bl", "cr", "sk", "y", "ay", "beaut", "rel", "tr", "ign", "ski", "bee", "o"]


def words():
    ends = [e for e, _ in stemming.STEP2 + stemming.STEP3] + stemming.STEP4
    ends += ["", "s", "es", "sses", "ied", "ies", "us", "ss", "eed", "eedly", "ed", "edly", "ing", "ingly", "y", "ly", "'s", "'s'", "'", "e", "le", "ll"]
    out = {a + b for a, b in itertools.product(ROOTS, ends)} | {a + b + c for a, b, c in itertools.product(ROOTS[:6], ends, ["s", "ed", "ing", "'s"])}
    out |= set(stemming.EXCEPTIONS) | set(stemming.AFTER_1A) | {w + "s" for w in stemming.AFTER_1A}
    r = random.Random(1)
    for _ in range(6000):
        out.add("".join(r.choice("aeiouybcdlstxwnr'") for _ in range(r.randint(1, 12))))
    return sorted(out | {"yyy", "byyy", "oyyy", "ayay", "日本語s", "éings", "a", "", "naïveness"})


def test_expressions_equal_the_plain_stemmer(spark):
    terms = words()
    rows = stemming.with_stem(spark.createDataFrame([(t,) for t in terms], "term string")).collect()
    wrong = [(r.term, r.stem, stem_word(r.term)) for r in rows if r.stem != stem_word(r.term)]
    assert len(rows) == len(terms) and not wrong, wrong[:20]


@pytest.mark.parametrize("hot", [100_000, 5])
def test_tokens_keep_their_rows(spark, monkeypatch, hot):
    monkeypatch.setattr(text, "HOT_TERMS", hot)
    r = random.Random(2)
    pool = words()[::40]
    docs = [(r.choice([1, 2, None]), r.choices(pool, k=r.randint(0, 30)), "kept") for _ in range(60)]
    df = spark.createDataFrame(docs, "id long, tokens array<string>, term string").repartition(3)
    found = text.stem_tokens(df, "tokens", "stems").collect()
    assert sorted(map(str, ((r.id, r.tokens, r.term, r.stems) for r in found))) == sorted(
        map(str, ((i, t, k, [stem_word(w) for w in t]) for i, t, k in docs)))
