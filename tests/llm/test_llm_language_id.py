import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL
from odd import TEXTS, no_documents, odd_documents, saved

from tablewright.llm import language_id as li


@pytest.fixture(scope="module")
def small(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").collect()
    return {r.doc_id: r.lang for r in docs}, li.op8_language_id(spark, SF_SMALL).collect()


def test_held_out_accuracy(small):
    right, rows = small
    assert len(rows) == len(right)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == right[r.doc_id] for r in held) >= 0.95 * len(held)


def test_every_learned_gram_is_found(spark):
    df = spark.createDataFrame([("aa", "kilo mega giga"), ("bb", "nano pico mega"), (None, "tera")], "lang string, text string")
    f = li.learn(df, min_share=0.0)
    assert f.languages == ["aa", "bb"]
    total, hits = f.counts(["kilo mega giga", "nano pico mega", ""])
    assert total[0] == hits[0][0] and total[1] == hits[1][1] and total[2] == 0
    assert hits[0][1] >= 3 and hits[0][1] < total[0]  # "mega" is in both
    assert [p[0] for p in f.predict(["kilo giga", "nano", None, "123 !", "z"])] == ["aa", "bb", "und", "und", "aa"]


def test_more_than_eight_languages(spark):
    names = [chr(97 + i) * 2 for i in range(11)]
    df = spark.createDataFrame([(n, f"{n}{n}x {n}wort{n} {n}oq") for n in names], "lang string, text string")
    f = li.learn(df, min_share=0.0)
    assert f.table.shape[0] == 2
    assert [p[0] for p in f.predict([f"{n}wort{n}" for n in names])] == names


CLEAN = [
    ("zh", "我们今天去公园散步天气很好"), ("zh", "图书馆里有许多新书"), ("zh", "他每天早上喝一杯茶"),
    ("ja", "きのうは雨が降りました"), ("ja", "カタカナとひらがなを学ぶ"), ("ja", "駅まで歩いて行きます"),
    ("th", "วันนี้อากาศดีมาก"), ("th", "ฉันชอบอ่านหนังสือ"), ("en", "a b c"), ("en", "ok"), ("en", "Zbigniew Brzezinski"),
    ("en", "for (int i = 0; i < n; i++) x[i] = y[i];"),
]


def test_stage_keeps_clean_short_and_unspaced_texts(spark):
    import corpus_pipeline as cp

    # 400 documents of each language, so that an n-gram of one document is below MIN_SHARE
    filler = {"zh": range(0x4E00, 0x4F00), "ja": [*range(0x3041, 0x3090), *range(0x30A1, 0x30F0)], "th": range(0x0E01, 0x0E2E),
              "en": range(ord("a"), ord("z") + 1)}
    rows = []
    for lang, points in filler.items():
        step = 5 if lang == "en" else 14
        for i in range(400):
            held = [chr(points[zlib.crc32(f"{lang}{i}-{j}".encode()) % len(points)]) for j in range(28)]
            rows.append((len(rows), lang, " ".join("".join(held[k : k + step]) for k in range(0, 28, step))))
    clean = [(10_000 + i, lang, text) for i, (lang, text) in enumerate(CLEAN)]
    none = [(20_000, "en", "123 456"), (20_001, "en", None), (20_002, "en", "")]
    docs = spark.createDataFrame(rows + clean + none, "doc_id long, lang string, text string")
    kept = cp.known_language(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows + clean}
    found = {r.doc_id: r for r in li.predict(docs, li.learn(docs), ["doc_id"]).collect()}
    for i, lang, _ in clean:
        if lang != "zh":  # the filler holds few of its characters
            assert found[i].lang_pred == lang and found[i].score > 0, i


def test_popcounts_decide_what_stays_and_what_is_filled_in(spark):
    words = {"aa": "kilo mega giga", "bb": "nano pico femto"}
    rows = [(i, ("aa", "bb")[i % 2], words[("aa", "bb")[i % 2]]) for i in range(40)]
    rows += [(100, None, "kilo giga mega"), (101, None, "femto nano"), (102, "aa", "pico femto pico"), (103, None, "12 34"), (104, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    filters = li.learn(docs.where("doc_id < 40"))
    kept = {r.doc_id: r.lang for r in li.settle(docs, filters).collect()}
    assert kept == {r[0]: r[1] for r in rows[:40]} | {100: "aa", 101: "bb", 102: "aa"}
    wanted = {r.doc_id for r in li.settle(docs, filters, wanted=["aa"]).collect()}
    assert wanted == {r[0] for r in rows[:40] if r[1] == "aa"} | {100}
    # nothing learned: no ground to drop what has letters
    assert li.settle(docs, li.learn(docs.limit(0))).count() == 43


LETTERLESS = ["²" * 100, "①② " * 60, "Ⅷ½¾ " * 50, "١٢٣ " * 40, "_ - _", "\u0300\u0301", "𐄇𝟘 🄂" * 30, "", None]


def test_only_letters_make_a_language(spark):
    f = li.learn(spark.createDataFrame([("en", "some words"), ("xx", "² ① a")], "lang string, text string"), min_share=0.0)
    assert f.predict(LETTERLESS) == [("und", 0.0)] * len(LETTERLESS)
    assert all(p[0] in f.languages for p in f.predict(["²" * 5000 + "a", "é", "日", "ª"]))
    assert f.counts(["² ① word", "word"])[0].tolist() == [f.counts(["word"])[0][0]] * 2


def exact_sets(rows, min_share):
    """N-grams by language in plain sets: those in at least min_share of its documents."""
    held, sizes = {}, Counter(lang for lang, _ in rows)
    for lang, text in rows:
        held.setdefault(lang, Counter()).update(set(plain_grams(text)))
    return {x: {g for g, n in c.items() if n >= max(1.0, min_share * sizes[x])} for x, c in held.items()}


def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    for word in (f" {w} " for w in words):
        for size in range(1, 5):
            for at in range(len(word) - size + 1):
                g = word[at : at + size]
                if not (g[0] == " " == g[-1]):
                    yield g


def test_filters_against_exact_sets(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text").collect()
    rows = [(r.lang, r.text) for r in docs if r.lang and r.text]
    sets = exact_sets(rows, li.MIN_SHARE)
    f = li.learn(spark.createDataFrame(rows, "lang string, text string"))
    assert sorted(sets) == sorted(f.languages)
    texts = [t for _, t in rows]
    total, hits = f.counts(texts)
    estimate = np.maximum(hits - total[:, None] * f.false_rate, 0) / (1 - f.false_rate)
    for i, (text, (name, score)) in enumerate(zip(texts, f.predict(texts))):
        grams = list(plain_grams(text))
        exact = {x: sum(g in held for g in grams) for x, held in sets.items()}
        assert total[i] == len(grams)
        for j, x in enumerate(f.languages):
            assert hits[i, j] >= exact[x]  # a filter finds all that it holds
            # beyond them only false positives, which the correction takes away on average
            assert abs(estimate[i, j] - exact[x]) <= 0.01 * len(grams) + 5 * max(exact.values()) ** 0.5
        best = max(exact.values())
        assert exact[name] >= best - 0.01 * len(grams) - 1


def test_no_language_is_left_out(spark):
    names = [f"l{i:04d}" for i in range(1030)]
    word = {n: "".join(chr(97 + int(c)) for c in n[1:]) for n in names}
    f = li.learn(spark.createDataFrame([(n, f"x{word[n]}") for n in names], "lang string, text string"))
    assert f.languages == names
    assert f.predict([f"x{word[n]}" for n in names[-3:]]) == [(n, f.predict([f"x{word[n]}"])[0][1]) for n in names[-3:]]


def test_odd_rows_and_empty_table(spark, tmp_path):
    folder = saved(odd_documents(spark), tmp_path / "odd")
    rows = li.op8_language_id(spark, folder).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.doc_id in (3, 4, 5, 7):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert all(r.lang_pred != "und" for r in rows if r.doc_id in (1, 6, 8, 12))
    none = saved(no_documents(spark), tmp_path / "none")
    assert li.op8_language_id(spark, none).count() == 0
    docs = odd_documents(spark)
    kept = li.settle(docs, li.learn(docs))
    assert kept.columns == docs.columns and kept.where("text is null or doc_id = 7").count() == 0
    assert li.learn(no_documents(spark)).predict(["text"]) == [("und", 0.0)]
