import zlib

import numpy as np
from odd import TEXTS, no_documents, odd_documents, saved

from tablewright.llm import quality_classifier as qc
from tablewright.llm.common import WordHash


def test_held_out_accuracy(spark):
    rows = qc.op5_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == y for r, y in held]) >= 0.93
    good, bad = ([r.score for r, y in held if y == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_features_do_not_depend_on_pieces(monkeypatch):
    body = ("one two two three, four!! " * 40).encode()
    whole = qc.features(body, WordHash())
    cut = body.index(b"three", 300)
    monkeypatch.setattr(qc, "pieces", lambda b: [b[:cut], b[cut:]])
    parts = qc.features(body, WordHash())
    assert whole[0].tolist() == parts[0].tolist() and np.allclose(whole[1], parts[1])


def test_ftrl_separates_and_drops_noise():
    r = np.random.default_rng(0)
    rows = []
    for i in range(400):
        y = i % 2
        at = np.unique(np.concatenate(([0, 5 + y], r.integers(100, 4000, 20))))
        rows.append((y, at, np.ones(len(at))))
    met, w = qc.ftrl(rows, bits=12, epochs=3)
    dense = np.zeros(1 << 12)
    dense[met] = w
    assert dense[6] > 1 and dense[5] < -1 and (np.abs(dense[100:]) < 0.5).mean() > 0.95 and (w == 0).any()


def test_labels_with_nulls_and_repeats(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, None), (7, 0), (8, 1), (99, 0)], "doc_id long, quality int")
    folder = saved(odd_documents(spark), tmp_path / "odd", labels=labels)
    rows = qc.op5_quality_classifier(spark, folder).collect()
    assert len(rows) == len(TEXTS) and len({r.score for r in rows if r.doc_id in (3, 4, 5)}) == 1
    none = saved(no_documents(spark), tmp_path / "none", labels=labels.limit(0))
    assert qc.op5_quality_classifier(spark, none).count() == 0
    unlabelled = saved(odd_documents(spark), tmp_path / "unlabelled", labels=labels.limit(0))
    assert {r.score for r in qc.op5_quality_classifier(spark, unlabelled).collect()} == {0.5}
