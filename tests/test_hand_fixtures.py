"""Hand fixtures with answers computed by hand (FIXTURES.md §4)."""

import math

from pyspark.sql import functions as F

from tablewright.functions import text as tf
from tablewright.operators import clean, evaluate, features, profile, splits, text


def test_empty_frame_describe(spark):
    df = spark.createDataFrame([], "x double")
    r = profile.describe(df, ["x"]).first()
    assert r["count"] == 0 and r["mean"] is None


def test_all_null_column_and_nan_vs_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (None, None)], "a double, b double")
    nulls = clean.null_counts(df).first()
    nans = clean.nan_counts(df).first()
    assert (nulls["a"], nulls["b"]) == (3, 1)
    assert (nans["a"], nans["b"]) == (0, 1)
    assert clean.drop_missing(df, subset=["b"]).count() == 1
    assert clean.missing_fraction(df).first()["b_missing"] == 1 - 2 / 3


def test_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "n double, d double")
    assert [r["q"] for r in clean.ratio(df, "n", "d", "q").collect()] == [None, 2.0]


def test_fill_missing_casts_literal(spark):
    df = spark.createDataFrame([(None,), ("x",)], "s string")
    assert sorted(r["s"] for r in clean.fill_missing(df, {"s": 0}).collect()) == ["0", "x"]


def test_drop_columns_strict(spark):
    df = spark.createDataFrame([(1,)], "a int")
    try:
        clean.drop_columns(df, ["total_payment"])
    except ValueError:
        pass
    else:
        raise AssertionError("unknown column must raise")


def test_trim_report_counts_from_same_predicate(spark):
    df = spark.createDataFrame([(x,) for x in [5.0, 19.9, 20.0, 25.0, None]], "r double")
    rep = clean.trim_report(df, {"r": (None, 20)}).first()
    assert rep["r_dropped"] == 3 and rep["n_kept"] == 2
    assert clean.trim_outliers(df, {"r": (None, 20)}).count() == 2


def test_tied_scores_roc_and_auc(spark):
    rows = [(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0)]
    df = spark.createDataFrame(rows, "s double, y int")
    # by hand: P=2, N=2; group 0.9 -> (tp1, fp1): area 1*(0+0.5); 0.5 -> no fp; 0.1 -> fp1: 1*(2+0)
    assert math.isclose(evaluate.auc(df, "s", "y").first()["auc"], (0.5 + 2.0) / 4)
    pts = {r["threshold"]: (r["tpr"], r["fpr"]) for r in evaluate.roc_points(df, "s", "y").collect()}
    assert pts == {0.9: (0.5, 0.5), 0.5: (1.0, 0.5), 0.1: (1.0, 1.0)}


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame([(0.3, 1), (0.2, 1)], "s double, y int")
    assert evaluate.auc(df, "s", "y").first()["auc"] is None


def test_auc_hard_is_mean_of_rates(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (0, 0)], "p int, y int")
    assert evaluate.auc_hard(df, "p", "y").first()["auc_hard"] == (0.5 + 1.0) / 2


def test_unseen_category_at_scoring(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    test = spark.createDataFrame([("z",)], "c string")
    m = features.index_category("c").fit(train)
    assert m.transform(test).first()["c_index"] == 2.0


def test_constant_feature_standardizes_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    stats = features.fit_standardize_columns(df, ["x"])
    assert [r["x"] for r in features.apply_standardize_columns(df, stats).collect()] == [0.0, 0.0]


def test_text_cleaning_by_hand(spark):
    df = spark.createDataFrame([(1, "What's this? I can't\r\nsee 3 cats, I'm sure.\nthe end"), (2, "the and of")], "doc_id long, text string")
    out = {r["doc_id"]: r["tokens"] for r in text.clean_text(df, stemming=False).collect()}
    # contractions run before lower-casing: "What's" misses its own rule and only
    # loses "'s" ("what" is then a stop word); "can't" -> "ca not"; the digit
    # masks the rest of its line (including "I'm"); stop words go
    assert out[1] == ["ca", "see", "digits", "end"]
    assert out[2] == []


def test_sequence_longer_than_maxlen(spark):
    df = spark.createDataFrame([([5, 6, 7, 8],), ([9],)], "seq array<int>")
    got = [r["p"] for r in df.select(tf.pad_sequences("seq", 3).alias("p")).collect()]
    assert got == [[6, 7, 8], [0, 0, 9]]
    got = [r["t"] for r in df.select(tf.truncate_vocab("seq", 7).alias("t")).collect()]
    assert got == [[5, 6, 0, 0], [0]]


def test_vocabulary_and_sequences(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["c", "b"]), (3, [])], "doc_id long, tokens array<string>")
    vocab = text.build_vocabulary(df, "tokens")
    ids = {r["term"]: r["term_id"] for r in vocab.collect()}
    assert ids == {"b": 2, "a": 3, "c": 4}
    val = spark.createDataFrame([(7, ["c", "zz", "b"])], "doc_id long, tokens array<string>")
    seq = text.encode_sequence(val, "doc_id", "tokens", vocab, hot_terms=1).first()["seq"]
    assert seq == [4, 1, 2]


def test_stemmer_examples(spark):
    words = ["running", "cats", "generously", "ponies", "happy"]
    df = spark.createDataFrame([(1, words), (2, None), (2, []), (None, ["cats", None, "dogs"])], "id int, tokens array<string>")
    rows = [(r.id, r.tokens) for r in text.stem_tokens(df, "tokens").collect()]
    want = [(1, ["run", "cat", "generous", "poni", "happi"]), (2, None), (2, []), (None, ["cat", None, "dog"])]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_stratified_folds_are_balanced_and_complete(spark):
    df = spark.range(0, 300).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    f = splits.stratified_folds(df, "y", 3, 7, ["id"])
    counts = {(r["y"], r["fold"]): r["count"] for r in f.groupBy("y", "fold").count().collect()}
    assert counts == {(0, 0): 90, (0, 1): 90, (0, 2): 90, (1, 0): 10, (1, 1): 10, (1, 2): 10}


def test_split_is_partition_invariant(spark):
    df = spark.range(0, 1000)
    a = splits.assign_split(df.repartition(1), [0.8, 0.2], 1, ["id"])
    b = splits.assign_split(df.repartition(7), [0.8, 0.2], 1, ["id"])
    assert a.join(b.withColumnRenamed("split", "s2"), "id").filter("split != s2").count() == 0


def test_collapse_rare(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [("c",)], "lvl string")
    out = sorted(r["lvl"] for r in clean.collapse_rare(df, "lvl", 3, "OTHER").collect())
    assert out == ["OTHER"] * 3 + ["a"] * 5


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    h = {r["bin"]: r["count"] for r in profile.histogram(df, "x", 2).collect()}
    assert h == {0: 1, 1: 2}


def test_correlation_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "c"], digits=9).collect()}
    right = np.corrcoef(x.T)
    assert all(abs(got[a, b] - right[i, j]) < 1e-8 for i, a in enumerate("abc") for j, b in enumerate("abc"))
