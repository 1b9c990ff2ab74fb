"""Conversation structure repair: a survivor-coalescence Viterbi over each conversation's rows.

A row is kept, reroled (to user or assistant) or deleted, and empty user or assistant rows are inserted, at the least
cost that leaves role initials ``(s?(ua)+)?``.  Four states tell what the next role may be.  The best edits into each
state are its survivor; survivors are leaves of one backpointer tree whose nodes count their references.  A branch
without a survivor goes at once, and as soon as all survivors share an ancestor its edits are emitted and forgotten,
so what is held is the unresolved part only.  A survivor that costs more than another one can cost however the
conversation goes on (``SLACK``) is no survivor.

Ties go to the ASCII-least edits.  The complete unresolved suffixes decide; they are not reread for each tie but
carried along in order: survivors of different ``rank`` differ before any later edit, those of one rank share all their
edits but a ``tail`` of insertions.

Equal rows are counted before they are shuffled.  The SHA-256 of a conversation's repaired text has to read that
text in order, so a conversation is streamed through one task, sorted by Spark, never held: a survivor carries the
state of its hash, a run of copies is one step, and whether a row repeats an earlier one is found by a window.

Nulls: a null role or text is one space, a null turn comes first, rows with a null conversation form one conversation.
An empty role has no initial and can't be kept.  Rows of one turn are ordered by role and text.  Empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablewright.llm.common import sliced

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
SPACES = " \t\n\x0b\x0c\r"
# the state that a kept initial leads to; a reroled or inserted row is the user, after the user the assistant
KEPT = (
    {"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER},
)
TURNED = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# SLACK[x][y]: what the rest may cost more from state x than from state y, whatever the rest is
SLACK = (
    (0, 0, INSERT, 0),
    (2 * INSERT, 0, INSERT, 2 * INSERT),
    (INSERT + DELETE, INSERT, 0, INSERT),
    (DELETE, 0, INSERT, 0),
)
LEGAL = {"su", "ua", "au"}


class Node:
    """An edit (or a run of deletions) in the backpointer tree."""

    __slots__ = ("up", "edit", "item", "refs", "kids")

    def __init__(self, up: Node | None, edit: str, item: object):
        self.up, self.edit, self.item, self.refs, self.kids = up, edit, item, 0, []
        if up is not None:
            up.kids.append(self)
            up.refs += 1


class Survivor:
    __slots__ = ("cost", "rank", "tail", "node", "sha")

    def __init__(self, cost: int, rank: int, tail: str, node: Node, sha: object):
        self.cost, self.rank, self.tail, self.node, self.sha = cost, rank, tail, node, sha


class Repairer:
    """Cheapest edits of one conversation; ``emit(edit, item)`` gets them in order, as early as they are certain.

    An item is (role, text) of the repaired row, None for deletions.  With ``hashed`` nothing but edits is held:
    items are None, and ``sha`` of the result digests the repaired rows.
    """

    def __init__(self, emit: Callable[[str, object], None], hashed: bool = False):
        self.emit, self.hashed = emit, hashed
        self.root = Node(None, "", None)
        self.root.refs = 1
        self.held = {START: Survivor(0, 0, "", self.root, hashlib.sha256() if hashed else None)}
        self.inserts()

    def row(self, initial: str, role: str, text: str, truncated: bool) -> None:
        """A row that may stay."""
        best: dict[int, tuple] = {}
        extra = TRUNCATED if truncated else 0
        for state, s in self.held.items():
            self._offer(best, state, s.cost + DELETE, s, "D", None)
            to = KEPT[state].get(initial)
            if to is not None:
                self._offer(best, to, s.cost + KEEP + extra, s, "K", role)
            to = TURNED[state]
            self._offer(best, to, s.cost + REROLE + extra, s, "R", ROLES[to])
        self._settle(best, text)
        self.inserts()

    def delete(self, times: int = 1) -> None:
        """Rows that must go.  Insertions before the last of them sort after the same ones behind it."""
        best: dict[int, tuple] = {}
        for state, s in self.held.items():
            self._offer(best, state, s.cost + times * DELETE, s, "D" * times, None)
        self._settle(best, "")
        self.inserts()

    def inserts(self) -> None:
        """Let survivors reach the other states by inserted rows."""
        for states, to in (((START, SYSTEM, ASSISTANT), USER), ((USER,), ASSISTANT)):
            best: dict[int, tuple] = {}
            for state in states:
                s = self.held.get(state)
                if s is not None:
                    self._offer(best, to, s.cost + INSERT, s, "I", ROLES[to])
            old = self.held.get(to)
            if best and (old is None or best[to][0] < (old.cost, old.rank, old.tail)):
                _, s, edit, role = best[to]
                # the replaced survivor may be what the new one builds on: take the new reference first
                self.held[to] = self._grown(best[to][0], s, edit, role, "", s is self.held.get(START))
                if old is not None:
                    self._release(old.node)
        self._prune()

    def _offer(self, best: dict, to: int, cost: int, s: Survivor, edit: str, role: str | None) -> None:
        key = (cost, s.rank, s.tail + edit)
        if to not in best or key < best[to][0]:
            best[to] = (key, s, edit, role)

    def _grown(self, key: tuple, s: Survivor, edit: str, role: str | None, text: str, first: bool) -> Survivor:
        item, sha = None, s.sha
        if role is not None:
            if self.hashed:
                sha = sha.copy()
                sha.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
            else:
                item = (role, text)
        node = Node(s.node, edit, item)
        node.refs += 1
        return Survivor(*key, node, sha)

    def _settle(self, best: dict, text: str) -> None:
        old, none = self.held, self.held.get(START)
        self.held = {to: self._grown(key, s, edit, role, text, s is none) for to, (key, s, edit, role) in best.items()}
        for s in old.values():
            self._release(s.node)

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.up is not None:
            up = node.up
            up.kids.remove(node)
            up.refs -= 1
            node = up

    def _prune(self) -> None:
        held = self.held
        for y in list(held):
            if any(held[y].cost > s.cost + SLACK[x][y] for x, s in held.items()):
                self._release(held.pop(y).node)
        # survivors in order; those that begin with another one's edits share its rank
        rank, base, last = -1, None, None
        for s in sorted(held.values(), key=lambda s: (s.rank, s.tail)):
            if s.rank != last or not s.tail.startswith(base):
                rank, base, last = rank + 1, s.tail, s.rank
            s.rank, s.tail = rank, s.tail[len(base) :]
        self._advance()

    def _advance(self) -> None:
        """Emit what all survivors share."""
        while self.root.refs == 1 and self.root.kids:
            self.root = self.root.kids[0]
            self.root.up = None
            self.emit(self.root.edit, self.root.item)

    def finish(self) -> Survivor:
        """End the conversation: the cheapest of no rows and a last assistant's."""
        ends = [self.held[x] for x in (START, ASSISTANT) if x in self.held]
        best = min(ends, key=lambda s: (s.cost, s.rank, s.tail))
        for s in self.held.values():
            if s is not best:
                self._release(s.node)
        self._advance()
        return best

    def open_edits(self) -> int:
        """How many edits are held."""
        count, todo = 0, list(self.root.kids)
        while todo:
            node = todo.pop()
            count += 1
            todo += node.kids
        return count


def prepared(df: DataFrame, live: Column | None = None) -> DataFrame:
    """Equal rows counted, their faults marked, each conversation in one partition and in order.

    Rows that are not ``live`` only keep their conversation in the result.
    """
    live = F.lit(True) if live is None else F.coalesce(live, F.lit(False))
    rows = df.select(
        "conv_id", live.alias("live"), F.when(live, F.col("turn")).alias("turn"),
        F.when(live, F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(live, F.coalesce(F.col("text"), F.lit(" "))).alias("text"),
    )
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")).repartition("conv_id")
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    # this window needs no shuffle of its own: its rows are in one partition already
    again = Window.partitionBy("conv_id", "live", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    marked = counted.select(
        "*", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.substring("role", 1, 1).alias("initial"), (F.row_number().over(again) == 1).alias("first"),
    )
    return marked.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


class Counts:
    """Faults of a conversation, counted as its rows pass."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.last = None

    def add(self, row: dict) -> tuple[bool, int]:
        """(whether the first copy may stay, copies that must go)."""
        n, initial, turn = row["n"], row["initial"], row["turn"]
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.distinct += 1
        self.illegal += (n - 1) * (initial * 2 not in LEGAL)
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.last = initial
        stays = row["first"] and not row["blank"]
        self.blank += n if row["blank"] else 0
        self.duplicate += 0 if row["blank"] else n - stays
        self.truncated += bool(stays and row["truncated"])
        return stays, n - stays

    def values(self) -> tuple[int, ...]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def _walk(batches: Iterator[pa.RecordBatch], begin: Callable, row: Callable, end: Callable) -> Iterator[None]:
    """Pass the rows of sorted conversations on; a pause after every block lets results leave."""
    current, open_ = None, False
    for batch in sliced(batches, 500):
        for r in batch.to_pylist():
            if not open_ or r["conv_id"] != current:
                if open_:
                    end(current)
                current, open_ = r["conv_id"], True
                begin(current)
            if r["live"]:
                row(r)
        yield
    if open_:
        end(current)
        yield


def audit(df: DataFrame, live: Column | None = None) -> DataFrame:
    """One row for each conversation: faults, cost, the edits' initials and the digest of the repaired rows."""
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = StructType([
        df.schema["conv_id"], *(StructField(c, LongType()) for c in names), StructField("audit", StringType()),
        StructField("repaired_sha256", StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: dict = {}

        def begin(_: object) -> None:
            edits: list[str] = []
            now.update(edits=edits, counts=Counts(), repairer=Repairer(lambda e, _: edits.append(e), hashed=True))

        def row(r: dict) -> None:
            stays, gone = now["counts"].add(r)
            if stays:
                now["repairer"].row(r["initial"], r["role"], r["text"], r["truncated"])
            if gone:
                now["repairer"].delete(gone)

        def end(conv: object) -> None:
            best = now["repairer"].finish()
            done.append((conv, *now["counts"].values(), best.cost, "".join(now["edits"]), best.sha.hexdigest()))

        for _ in _walk(batches, begin, row, end):
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
                done.clear()

    return prepared(df, live).mapInArrow(run, schema)


def repair(df: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position (from 0), edit (K, R or I), role, text.  A conversation may lose all."""
    schema = StructType([
        df.schema["conv_id"], StructField("position", LongType()), StructField("edit", StringType()),
        StructField("role", StringType()), StructField("text", StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: dict = {}

        def begin(conv: object) -> None:
            def emit(edit: str, item: tuple | None) -> None:
                if item is not None:
                    done.append((conv, now["at"], edit, *item))
                    now["at"] += 1

            now.update(at=0, repairer=Repairer(emit))

        def row(r: dict) -> None:
            stays = r["first"] and not r["blank"]
            if stays:
                now["repairer"].row(r["initial"], r["role"], r["text"], r["truncated"])
            if r["n"] > stays:
                now["repairer"].delete(r["n"] - stays)

        for _ in _walk(batches, begin, row, lambda _: now["repairer"].finish()):
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), arrow)], schema=arrow)
                done.clear()

    return prepared(df).mapInArrow(run, schema)


def damage(df: DataFrame) -> DataFrame:
    """Damage rows by crc32 of ``conv_id:turn`` modulo 20; rows that are dropped stay with ``live`` false."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = (F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20).alias("kind")
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = df.select("conv_id", "turn", "role", text.alias("text"), kind)
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("live"), F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )
    twice = F.explode(F.array_repeat(F.lit(True), F.col("copies")))
    return rows.select("conv_id", "turn", "role", "text", "live", twice.alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    return audit(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")), F.col("live"))
