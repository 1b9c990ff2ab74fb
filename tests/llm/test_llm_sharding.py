import zlib
from collections import Counter

import pytest
from odd import TEXTS, no_documents, odd_documents, saved

from tablewright.llm import common, sharding


@pytest.fixture(scope="module")
def odd_rows(spark, tmp_path_factory):
    folder = saved(odd_documents(spark), tmp_path_factory.mktemp("odd"))
    return sharding.op1_sharding(spark, folder).collect()


def test_every_row_once_with_gapless_slots(odd_rows):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in odd_rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    slots = {}
    for r in odd_rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_key_decides(odd_rows):
    by_key = {}
    for r in odd_rows:
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)


def _shards(spark, n_or_leaves, n=20_000):
    leaves = sharding.layout(n_or_leaves) if isinstance(n_or_leaves, int) else n_or_leaves
    df = sharding.assign(spark.range(n).withColumnRenamed("id", "doc_id"), leaves)
    return {r[0]: tuple(r[1]) for r in df.select("doc_id", "place").collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    held = {k: _shards(spark, k) for k in (24, 25, 26)}
    for k in (24, 25):
        moved = [d for d in held[k] if held[k][d] != held[k + 1][d]]
        assert {held[k + 1][d][2] for d in moved} == {k}
        assert 0.7 / (k + 1) < len(moved) / 20_000 < 1.4 / (k + 1)
    counts = Counter(p[2] for p in held[24].values())
    assert len(counts) == 24 and max(counts.values()) < 1.25 * 20_000 / 24


def test_a_weight_moves_rows_only_through_its_subtree(spark):
    leaves = sharding.layout(24)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in leaves]
    before, after = _shards(spark, leaves), _shards(spark, heavier)
    rack = next((x.region, x.rack) for x in leaves if x.shard == 5)
    for d in before:
        if before[d] != after[d]:
            assert after[d][0] == rack[0]  # rows only move into the region that grew
            if before[d][0] == rack[0]:
                assert after[d][:2] == rack  # inside it only into the rack that grew
                if before[d][:2] == rack:
                    assert after[d][2] == 5
    share = Counter(p[2] for p in after.values())[5] / 20_000
    assert abs(share - 3 / 26) < 0.02


def test_slots_expand_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(common, "EXPAND", 4)
    df = spark.createDataFrame([(7, 1)] * 11 + [(8, 1), (9, 2)], "doc_id long, g int")
    rows = sharding.slots(df, "g", ["doc_id"], 2).collect()
    assert sorted(r.slot for r in rows if r.g == 1) == list(range(12))
    assert len({r.slot for r in rows if r.doc_id == 7}) == 11


def test_rows_of_one_id_spread_over_buckets(spark):
    df = spark.range(2000).selectExpr("cast(null as long) doc_id", "id mark", "1 g")
    rows = sharding.slots(df, "g", ["doc_id", "mark"], 2).collect()
    assert sorted(r.slot for r in rows) == list(range(2000))
    # ordered by a hash of all columns, not by the id's hash and then the mark
    assert [r.mark for r in sorted(rows, key=lambda r: r.slot)] != list(range(2000))


def test_empty_table(spark, tmp_path):
    assert sharding.op1_sharding(spark, saved(no_documents(spark), tmp_path)).count() == 0
