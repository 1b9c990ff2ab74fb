import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import LONG, TEXTS, no_documents, odd_documents, saved

from tablewright.llm import quality_rules as q


def brute(ids, window=8, least=6):
    n, longest, places = len(ids), [0] * len(ids), {}
    for i in range(n):
        for j in range(n):
            size = 0
            while i != j and max(i, j) + size < n and ids[i + size] == ids[j + size]:
                size += 1
            longest[i] = max(longest[i], size)
    for size in range(least, n):
        for i in range(n - size + 1):
            places.setdefault(tuple(ids[i : i + size]), []).append(i)
    maximal = 0
    for text, at in places.items():
        left = {ids[i - 1] if i else None for i in at}
        right = {ids[i + len(text)] if i + len(text) < n else None for i in at}
        maximal += len(at) > 1 and (len(left) > 1 or left == {None}) and (len(right) > 1 or right == {None})
    in_windows = {p for i in range(n) if longest[i] >= window for p in range(i, i + window)}
    in_repeats = {p for i in range(n) if longest[i] >= least for p in range(i, i + longest[i])}
    return len(in_windows), len(in_repeats), max(longest, default=0), maximal


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_repetition_equals_brute_force(ids):
    found, right = q.repetition(np.array(ids, np.int64)), brute(ids)
    assert found[:3] == right[:3]
    if right[2] >= 6:
        assert found[3] == right[3]


def base(text):
    words = [w for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(words) < 300 else set()
    inside = {p for i, w in enumerate(windows) if w in twice for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(list("ab é#|\n\t\x0b\x1c\x85日") + ["one two three four five six seven eight "]), max_size=60)
       .map("".join))
def test_base_counts_equal_brute_force(text):
    assert q.rules(text.encode())[:5] == base(text)


def test_verdict():
    words = [f"w{i}" for i in range(200)]
    assert q.rules(" ".join(words).encode())[6] is True
    assert q.rules(" ".join(words[:10]).encode())[5:7] == (True, False)  # too few words
    seven = " ".join([*words, *(w for i in range(12) for w in [*words[i * 7 : i * 7 + 7], f"x{i}"])])
    share = q.rules(seven.encode())
    assert share[5] is False and share[6] is False and share[7] > q.MAX_COVERED  # only the suffix array sees these
    once = " ".join(words + [f"y{i}" for i in range(60)] + words[:60])
    assert q.rules(once.encode())[8] == 60


def test_one_long_repeat_decides_alone():
    for n, size in ((5000, 700), (5000, q.MAX_LONGEST + 1), (400, q.MAX_LONGEST + 1)):
        words = [f"w{i}" for i in range(n - size)]
        found = q.rules(" ".join(words + words[:size]).encode())
        assert found[5] is False and found[7] <= q.MAX_COVERED and found[8] == size
        assert found[6] is False
    words = [f"w{i}" for i in range(400)]
    assert q.rules(" ".join(words + words[: q.MAX_LONGEST]).encode())[6] is True


def test_odd_rows_and_empty_table(spark, tmp_path):
    rows = q.op4_quality_rules(spark, saved(odd_documents(spark), tmp_path / "odd")).collect()
    assert len(rows) == len(TEXTS)
    assert all(r.n_words == 0 and not r.kept for r in rows if r.doc_id in (3, 4, 5))
    assert next(r for r in rows if r.doc_id == 8).n_words == len(LONG.split())
    assert q.op4_quality_rules(spark, saved(no_documents(spark), tmp_path / "none")).count() == 0
