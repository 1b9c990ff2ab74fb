import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from odd import TEXTS, no_documents, odd_documents, saved
from tokenizers import Tokenizer

from tablewright.llm import packing


@pytest.fixture(scope="module")
def right():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    tokenizer.encode_special_tokens = True
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END]


def check(pieces, texts, right, window=4096):
    """Every id in exactly one piece, sequences gapless; returns the padding of each sequence."""
    docs, sequences = {}, {}
    for p in pieces:
        docs.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    for doc_id, text in texts.items():
        ids, at = np.array(right(text), "<u4"), 0
        for p in sorted(docs[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
    assert set(docs) == set(texts)
    padding = []
    for held in sequences.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == held[0].sequence_tokens <= window
        padding.append(window - at)
    return padding


def test_small_table(spark, right):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    padding = check(packing.op3_lexical_packing(spark, SF_SMALL).collect(), texts, right)
    assert sorted(padding)[:-1] == [0] * (len(padding) - 1)  # one partition: only its last window is short


@pytest.mark.parametrize("window, shard_tokens", [(64, 500), (4096, 1), (7, 10_000)])
def test_windows_and_shards(spark, right, window, shard_tokens):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).repartition(2)
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces = packing.pack(docs, window=window, shard_tokens=shard_tokens, with_ids=True).collect()
    assert sum(x > 0 for x in check(pieces, texts, right, window)) <= 2
    assert all(len(p.ids) == p.length for p in pieces)


def test_neighbours_share_words():
    """Documents of one topic stand together though they come in turn."""
    r = np.random.default_rng(0)
    docs = [r.integers(1000 * (i % 4), 1000 * (i % 4) + 60, 100).astype("<u4") for i in range(80)]
    packer = packing.Packer(0, 400)
    packer.shard(list(range(80)), docs)
    packer.close()
    windows = {}
    for p in packer.done:
        windows.setdefault(p[6], set()).add(p[0] % 4)
    assert sum(len(t) == 1 for t in windows.values()) >= len(windows) - 4


def test_bm25_equals_plain_formula():
    docs = [np.array(x) for x in ([1, 2, 2, 9], [2, 3, 9], [4, 9], [1, 1, 1, 5, 9], [6, 9], [7, 8])]
    index, n, mean = packing.Index(docs), len(docs), np.mean([len(d) for d in docs])
    for seed in range(n):
        for d in range(n):
            total = 0.0
            for t in set(docs[seed].tolist()):
                tf, df = (docs[d] == t).sum(), sum(t in x for x in docs)
                idf = max(np.log((n - df + 0.5) / (df + 0.5)), 0)
                total += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean))
            assert index.scores(seed)[d] == pytest.approx(total)


def test_chunk_memory_changes_nothing(right, monkeypatch):
    monkeypatch.setattr(packing.Ids, "LIMIT", 5)
    ids = packing.Ids()
    texts = ["don't stop. Stop, stop.. İstanbul ΑΣ ß…. 12.5, a.b.c. <|endoftext|> é.", "é.\x85x \x1c y.", "", "stop. 日本。"] * 3
    for t in texts:
        assert ids.of([t.encode()])[0].tolist() == right(t)


def test_odd_rows_and_empty_table(spark, tmp_path, right):
    pieces = packing.op3_lexical_packing(spark, saved(odd_documents(spark), tmp_path / "odd")).collect()
    assert sum(p.length for p in pieces) == sum(len(right(t)) for _, t in TEXTS)
    assert sorted(p.doc_tokens for p in pieces if p.doc_id in (3, 4, 5)) == [1, 1, 1]
    assert packing.op3_lexical_packing(spark, saved(no_documents(spark), tmp_path / "none")).count() == 0
