import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, no_documents, odd_documents, saved

from tablewright.llm import decontam as dc

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items, width=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        v = words(body)
        size = min(width, len(v))
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


TINY = st.lists(st.sampled_from(["a", "B", "é", "c", "D9", " ", ", "]), max_size=40).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(TINY, st.lists(TINY, max_size=4))
def test_hits_equal_brute_force(text, bodies):
    items = list(enumerate(bodies))
    for width in (3, 10):
        held = dc.WindowSet([(i, b.encode()) for i, b in items], width)
        ids = held.numbers(text.encode())
        hit, found = set(), set()
        for start, size, owners in held.hits(ids):
            hit.update(range(start, start + size))
            found.update(map(str, owners))
        assert (len(ids), len(hit), sorted(found)) == brute(text, items, width)


def _bench(spark):
    rows = [(5, "Over the LAZY dog, and runs far away from the old house."), (50, "day"), (None, "quick brown fox"), (7, None),
            (8, "!"), (9, "over the lazy dog and runs far away from the old barn")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_blocks_give_the_same(spark, block_bytes):
    items = [tuple(r) for r in _bench(spark).collect()]
    rows = dc.scan_windows(odd_documents(spark), _bench(spark), block_bytes=block_bytes).collect()
    found = sorted((str(r.doc_id), r.n_words, sum(b - a for a, b in zip(r.hit_spans[::2], r.hit_spans[1::2])), r.item_ids) for r in rows)
    assert found == sorted((str(i), *brute(t, items)) for i, t in TEXTS)


def test_query_and_removal(spark, tmp_path):
    folder = saved(odd_documents(spark), tmp_path, benchmark=_bench(spark))
    rows = dc.op9_benchmark_decontamination(spark, folder).collect()
    hit = [r for r in rows if r.contaminated]
    assert {r.doc_id for r in hit} == {1, 2, None, 9}
    assert hit[0].items_sha256 == hashlib.sha256(b"5,9").hexdigest()
    assert {r.items_sha256 for r in rows if not r.contaminated} == {hashlib.sha256(b"").hexdigest()}
    docs = odd_documents(spark)
    kept = dc.remove(docs, _bench(spark), block_bytes=40)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) - len(hit)


def test_empty_tables(spark, tmp_path):
    none = saved(no_documents(spark), tmp_path / "a", benchmark=_bench(spark))
    assert dc.op9_benchmark_decontamination(spark, none).count() == 0
    folder = saved(odd_documents(spark), tmp_path / "b", benchmark=_bench(spark).limit(0))
    assert dc.op9_benchmark_decontamination(spark, folder).where("contaminated").count() == 0


def test_window_set_is_built_of_arrays():
    r = random.Random(3)
    items = [(i, " ".join(f"w{r.randrange(30_000)}" for _ in range(r.choice([0, 3, 9, 10, 400, 2000]))).encode()) for i in range(900)]
    items += [(900, " ".join(f"v{i}" for i in range(60)).encode())]
    items += [(9000 + i, items[-1][1]) for i in range(300)]  # one passage in many items
    began = time.time()
    held = dc.WindowSet(items, 10)
    n = len(held.flat)
    size = held.flat.nbytes + sum(h.nbytes + p.nbytes for _, h, p in held.tables.values())
    assert n > 300_000 and size < 20 * n and time.time() - began < 10
    text = b"before " + items[-1][1] + b" after"
    owners = [o for *_, o in held.hits(held.numbers(text))]
    assert len(owners) == 51 and all(len(o) == 301 for o in owners)
    for i, body in items[:40]:
        if body:
            assert {x for *_, o in held.hits(held.numbers(body)) for x in o} >= {i}
