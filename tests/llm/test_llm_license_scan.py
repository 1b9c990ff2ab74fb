import random
import re
import time

from odd import TEXTS, no_documents, odd_documents, saved

from tablewright.llm import license_scan as ls

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_base_equals_brute_force():
    draw, held = random.Random(2), ls.Notices()
    parts = ["GNU", "general", "public", "license", "Apache", "cc", "BY", "mit", "-", " ", "\n", "é", "License.", "x"]
    for _ in range(3000):
        t = " ".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        w = WORD.findall(t.translate({c: c + 32 for c in range(65, 91)}))
        places = [(i, lab) for p, lab in ls.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        right = (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))
        found = ls.judge(t.encode(), held)
        assert found[:5] == right and set(right[4].split(",")) - {""} <= set(found[5].split(","))


def test_every_notice_within_the_edits_is_found():
    """Pigeonhole: any notice with at most k edits is located by a seed and verified."""
    draw, held = random.Random(4), ls.Notices()
    for notice, label in ls.NOTICES.items():
        k = len(notice) // ls.CHARS_PER_EDIT
        for _ in range(25):
            chars = list(notice)
            for _ in range(draw.randint(0, k)):
                at = draw.randrange(1, len(chars) - 1)
                kind = draw.randrange(3)
                if kind == 0:
                    chars[at] = draw.choice("abcdefghij")
                elif kind == 1:
                    chars.insert(at, draw.choice("abcdefghij"))
                else:
                    del chars[at]
            changed = "".join(chars)
            assert edits(notice, changed) <= k
            found = held.search(f"some words before {changed} and after")
            near = [x for x in found if x[0] == label]
            # another notice may fit the changed text at least as well
            assert near or any(x[3] / x[4] <= edits(notice, changed) / len(notice) for x in found), changed


def test_labels_spans_and_score():
    held = ls.Notices()
    row = ls.judge("é x Licensd under teh Apache Licence, Version 2.0".encode(), held)
    assert row[1] == 0 and row[4] == "" and row[5] == "apache-2.0" and 0.8 < row[6] < 1
    assert row[7].startswith("apache-2.0:2:9:")
    assert ls.judge(b"This work is licensed under the GNU General Public License, version 3.", held)[5] == "gpl,gpl-3.0"
    assert ls.judge(b"Licensed under CC BY-NC 4.0.", held)[5] == "cc-by,cc-by-nc-4.0"
    assert ls.judge(b"nothing of that kind here", held)[4:7] == ("", "", 0.0)


def test_odd_rows_and_empty_table(spark, tmp_path):
    rows = ls.op6_license_scan(spark, saved(odd_documents(spark), tmp_path / "odd")).collect()
    assert len(rows) == len(TEXTS) and {r.labels for r in rows} == {""} and {r.first_word for r in rows} == {None}
    assert ls.op6_license_scan(spark, saved(no_documents(spark), tmp_path / "none")).count() == 0


def test_the_best_of_overlapping_matches():
    r = random.Random(5)

    def plain(found):
        kept = []
        for x in sorted(found, key=lambda x: (x[3] / x[4], -x[4], x[1], x[0])):
            if all(x[2] <= k[1] or k[2] <= x[1] for k in kept):
                kept.append(x)
        return sorted(kept, key=lambda x: (x[1], x[2], x[0]))

    for _ in range(200):
        found = [(r.choice("ab"), a, a + r.randint(1, 9), r.randint(0, 3), r.randint(5, 9)) for a in r.choices(range(60), k=25)]
        assert ls._best(found) == plain(found)
    many = [("a", 20 * i, 20 * i + 15, i % 3, 12) for i in range(60_000)]
    began = time.time()
    assert len(ls._best(many)) == 60_000 and time.time() - began < 10
