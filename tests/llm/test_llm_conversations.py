import hashlib
import itertools
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablewright.llm import conversations as cv

SCHEMA = StructType([
    StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()),
    StructField("text", StringType()), StructField("audit", StringType()), StructField("live", StringType()),
])


def plain(rows):
    """Faults and the cheapest edits by trying prefixes of edit strings, all of them: rows (role, text) in order."""
    seen, marked = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, kind))
    paths = [(0, "", ())]  # every path over the rows so far, insertions included

    def with_inserts(paths):
        out = list(paths)
        for c, a, done in paths:
            for many in (1, 2):
                for roles in itertools.product(("user", "assistant"), repeat=many):
                    out.append((c + 3 * many, a + "I" * many, (*done, *((r, "") for r in roles))))
        return [p for p in out if re.fullmatch(r"(s?(ua)*u?)?", "".join(r[:1] or "-" for r, _ in p[2]))]

    paths = with_inserts(paths)
    for role, text, kind in marked:
        new = []
        for c, a, done in paths:
            new.append((c + 4, a + "D", done))
            if kind not in ("blank", "duplicate"):
                extra = 3 if kind == "truncated" else 0
                new.append((c + extra, a + "K", (*done, (role, text))))
                for r in ("user", "assistant"):
                    new.append((c + 3 + extra, a + "R", (*done, (r, text))))
        paths = with_inserts(new)
    ends = [p for p in paths if re.fullmatch(r"(s?(ua)+)?", "".join(r[:1] for r, _ in p[2]))]
    cost, audit, done = min(ends)
    kinds = [m[2] for m in marked]
    return cost, audit, done, [kinds.count(k) for k in ("blank", "duplicate", "truncated")]


ROLES = ["system", "user", "assistant", "user", "assistant", " ", "tool"]
TEXTS = ["a.", "b", "", "c!", "d?", "e\n", " ", "f. "]


def feed(repairer, rows):
    seen = set()
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        if not bare or (role, text) in seen:
            repairer.delete()
        else:
            repairer.row(role[:1], role, text, bare[-1] not in ".!?")
        seen.add((role, text))
    return repairer.finish()


def test_cheapest_edits_against_all_edits():
    rng = random.Random(5)
    for _ in range(250):
        rows = [(rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(rng.randint(0, 4))]
        cost, audit, done, _ = plain(rows)
        edits, kept = [], []

        def emit(edit, item, edits=edits, kept=kept):
            edits.append(edit)
            kept += [item] if item else []

        best = feed(cv.Repairer(emit), rows)
        assert (best.cost, "".join(edits), tuple(kept)) == (cost, audit, done), rows
        edits.clear()
        best = feed(cv.Repairer(lambda e, _, edits=edits: edits.append(e), hashed=True), rows)
        assert "".join(edits) == audit
        assert best.sha.hexdigest() == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()


def strings(rows):
    """Viterbi over whole strings: compares complete edits for each tie."""
    best = {0: (0, "")}

    def inserts(best):
        for states, to in (((0, 1, 3), 2), ((2,), 3)):
            for s in states:
                if s in best:
                    best[to] = min(best.get(to, (10**9, "")), (best[s][0] + 3, best[s][1] + "I"))

    inserts(best)
    for initial, truncated, stays in rows:
        new = {}
        for s, (c, a) in best.items():
            moves = [(s, 4, "D")]
            if stays:
                moves += [(cv.TURNED[s], 3 + 3 * truncated, "R")]
                moves += [(cv.KEPT[s][initial], 3 * truncated, "K")] if initial in cv.KEPT[s] else []
            for to, more, edit in moves:
                new[to] = min(new.get(to, (10**9, "")), (c + more, a + edit))
        best = new
        inserts(best)
    return min(best[x] for x in (0, 3) if x in best)


@pytest.mark.parametrize("roles", ["suaux", "u", "a", "uua", "s", "ssua"])
def test_long_conversations_with_ties(roles):
    rng = random.Random(len(roles))
    for size in (30, 120, 400):
        rows = [(rng.choice(roles), rng.random() < 0.2, rng.random() < 0.85) for _ in range(size)]
        edits = []
        repairer = cv.Repairer(lambda e, _, edits=edits: edits.append(e), hashed=True)
        for initial, truncated, stays in rows:
            repairer.row(initial, initial, "x", truncated) if stays else repairer.delete()
        best = repairer.finish()
        assert (best.cost, "".join(edits)) == strings(rows)


def test_edits_leave_early_and_in_linear_time():
    repairer, held = cv.Repairer(lambda e, _: None, hashed=True), 0
    began = time.time()
    for i in range(100_000):
        repairer.row("ua"[i % 2], "user", "some text.", i % 97 == 0)
        held = max(held, repairer.open_edits())
    assert held < 12
    # no two survivors ever meet here: every tie compares suffixes of the whole conversation
    repairer = cv.Repairer(lambda e, _: None, hashed=True)
    for _ in range(100_000):
        repairer.row("u", "user", "x.", False)
    repairer.delete(10_000_000)
    assert repairer.finish().cost > 0 and time.time() - began < 60


def odd(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 1, "assistant", "Yes."), (1, 2, None, None), (1, None, "user", "x"),
        (None, 0, "user", "lost."), (None, None, None, "y!"), (2, 0, "", "no role."), (2, 5, "user", ""), (3, 7, "user", "long " * 300_000),
        (4, 0, "assistant", "日本。"), (4, 1, "user", "q?"),
    ]
    rows += [(5, 0, "user", "again.")] * 3000
    return spark.createDataFrame([(*r, "junk", "junk") for r in rows], SCHEMA).repartition(5)


def by_hand(rows, damaged):
    """The contract's columns of each conversation, row by row."""
    out = {}
    for conv in {r[0] for r in rows}:
        held = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20 if damaged else 9
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            held += [(turn is not None, turn or 0, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        held.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        turns = [r[1] for r in held if r[0]]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(held, held[1:])]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        seen, faults, steps = set(), [0, 0, 0], []
        for _, _, role, text in held:
            bare = text.strip(" \t\n\x0b\x0c\r")
            kind = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            if kind < 3:
                faults[kind] += 1
            seen.add((role, text))
            steps.append((role[:1], kind == 2, kind > 1))
        out[conv] = (gaps, *faults, illegal, *strings(steps))
    return out


def test_odd_rows(spark):
    df = odd(spark)
    rows = [tuple(r)[:4] for r in df.collect()]
    for damaged in (False, True):
        found = cv.audit(cv.damage(df), F.col("live")) if damaged else cv.audit(df)
        found = {r[0]: tuple(r)[1:8] for r in found.collect()}
        assert found == by_hand(rows, damaged)
    repaired = {}
    for r in cv.repair(df).collect():
        repaired.setdefault(r.conv_id, []).append(r)
    digests = {r.conv_id: r.repaired_sha256 for r in cv.audit(df).collect()}
    for conv, digest in digests.items():
        held = sorted(repaired.get(conv, []), key=lambda r: r.position)
        assert [r.position for r in held] == list(range(len(held)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in held))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in held).encode()).hexdigest() == digest


def test_query_and_empty_table(spark, tmp_path):
    from conftest import SF_SMALL

    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    found = {r[0]: tuple(r)[1:8] for r in cv.op11_conversation_repair(spark, SF_SMALL).collect()}
    assert found == by_hand(rows, True)
    odd(spark).limit(0).write.parquet(f"{tmp_path}/conversations.parquet")
    assert cv.op11_conversation_repair(spark, str(tmp_path)).count() == 0
