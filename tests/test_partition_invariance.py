"""Same results with 1 and 7 input partitions: folds, samples, vocabulary, forest."""

import pytest

from tablewright.jobs import fixtures as fx
from tablewright.operators import splits, text
from tablewright.operators.models import anomaly

from conftest import SF_SMALL


def _both(df):
    return df.repartition(1), df.repartition(7)


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_folds_and_samples(spark):
    li = fx.loan_like(spark, SF_SMALL).select(*fx.LOAN_KEY, "status")
    a, b = _both(li)
    for f in (
        lambda d: splits.stratified_folds(d, "status", 3, 5, fx.LOAN_KEY),
        lambda d: splits.folds(d, 4, 5, fx.LOAN_KEY),
        lambda d: splits.assign_split(d, [0.7, 0.3], 5, fx.LOAN_KEY),
        lambda d: splits.head_tail_split_seeded(d, 100, 5, fx.LOAN_KEY),
    ):
        assert _rows(f(a), f(a).columns) == _rows(f(b), f(b).columns)
    assert _rows(splits.sample_n(a, 50, 9, fx.LOAN_KEY), fx.LOAN_KEY) == _rows(splits.sample_n(b, 50, 9, fx.LOAN_KEY), fx.LOAN_KEY)


def test_vocabulary(spark):
    toks = text.clean_text(fx.text_like(spark, SF_SMALL), stemming=False).select("doc_id", "tokens")
    a, b = _both(toks)
    va, vb = text.build_vocabulary(a, "tokens"), text.build_vocabulary(b, "tokens")
    assert _rows(va, ["term", "term_count", "term_id"]) == _rows(vb, ["term", "term_count", "term_id"])


def test_isolation_forest(spark):
    df = fx.fraud_like(spark, SF_SMALL)
    feats = [f"v{i + 1}" for i in range(fx.FRAUD_DIMS)]
    a, b = _both(df)
    sa = anomaly.isolation_forest(a, feats, ["vec_id"], n_estimators=10, max_samples=64, seed=3).transform(a)
    sb = anomaly.isolation_forest(b, feats, ["vec_id"], n_estimators=10, max_samples=64, seed=3).transform(b)
    ra = dict(_rows(sa, ["vec_id", "anomaly_score"]))
    rb = dict(_rows(sb, ["vec_id", "anomaly_score"]))
    assert ra.keys() == rb.keys()
    assert all(ra[k] == pytest.approx(rb[k], abs=1e-12) for k in ra)
