"""Quality rules with suffix-array repetition.

Each document's words are numbered, a suffix array is built by prefix doubling, and the longest common prefixes of
neighbouring suffixes come from the doubling ranks.  The longest-common-prefix intervals are the maximal repeated
substrings; the union of their occurrences of ``MIN_REPEAT`` words or more must cover at most ``MAX_COVERED`` of the
words, and the longest repeat may not exceed ``MAX_LONGEST`` words, however little of the document it covers.

Nulls: a null text has no words, so it fails the base rule of 20 words.  Repeated rows are judged one by one, other
columns are ignored.  A document is one unit of work: memory is a few dozen bytes a word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from tablewright.llm.common import SEGMENT_BYTES, documents, scan, utf8

MIN_WORDS = 20
WINDOW = 8
MIN_REPEAT = 6
MAX_COVERED = 0.3
MAX_LONGEST = 50
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"


def word_numbers(text: bytes) -> np.ndarray:
    """The text's words as numbers, equal words alike."""
    known: dict[bytes, int] = {}
    parts = []
    for piece in pieces(text):
        words = piece.split()
        for w in words:
            if w not in known:
                known[w] = len(known)
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def pieces(text: bytes) -> list[bytes]:
    """Long texts in parts that end at a space or line end."""
    if len(text) <= 2 * SEGMENT_BYTES:
        return [text]
    out, at = [], 0
    while len(text) - at > SEGMENT_BYTES:
        ends = [e for e in (text.find(b" ", at + SEGMENT_BYTES), text.find(b"\n", at + SEGMENT_BYTES)) if e >= 0]
        if not ends:
            break
        out.append(text[at : min(ends)])
        at = min(ends)
    return [*out, text[at:]]


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, lcp) where lcp[r] is the common prefix, in words, of the suffixes at ranks r-1 and r; lcp[0]=0."""
    n = len(ids)
    if n < 2:
        return np.arange(n), np.zeros(n, np.int64)
    rank, levels, width = ids, [], 1
    order = np.argsort(rank, kind="stable")
    while True:
        levels.append(rank)
        second = np.zeros(n, np.int64)
        if width < n:
            second[:-width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + second
        order = np.argsort(key, kind="stable")
        held = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(held[1:] != held[:-1])))
        rank, width = new, width * 2
        if int(rank[order[-1]]) == n - 1:
            break
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        held = np.concatenate((levels[k], [-1]))
        same = (held[a] == held[b]) & (held[a] >= 0)
        step = same * (1 << k)
        lcp[1:] += step
        a += step
        b += step
    return order, lcp


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> int:
    """Positions inside the union of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def maximal_repeats(ids: np.ndarray, order: np.ndarray, lcp: np.ndarray, least: int) -> int:
    """The number of lcp intervals of at least ``least`` words that can't be extended to the left."""
    before = np.where(order > 0, ids[np.maximum(order - 1, 0)], -1 - order).tolist()
    count, stack, last = 0, [], -1  # of [lcp, the word before all occurrences, or None if they differ]

    def close(down_to: int) -> int | None:
        nonlocal count
        word = None
        while stack and stack[-1][0] > down_to:
            word = stack.pop()[1]
            count += word is None
            if stack and stack[-1][0] >= down_to:
                stack[-1][1] = stack[-1][1] if stack[-1][1] == word else None
        return word

    for r in np.flatnonzero(lcp >= least).tolist():
        height = int(lcp[r])
        if last != r - 1:
            close(0)
        word = before[r - 1]
        if stack and stack[-1][0] > height:
            word = close(height)
        if not stack or stack[-1][0] < height:
            stack.append([height, word])
        top = stack[-1]
        top[1] = top[1] if top[1] == before[r] else None
        last = r
    close(0)
    return count


def repetition(ids: np.ndarray, window: int = WINDOW, least: int = MIN_REPEAT) -> tuple[int, int, int, int]:
    """(words in windows found twice, words in repeats of ``least`` words or more, longest repeat, maximal repeats)."""
    n = len(ids)
    if n < 2:
        return 0, 0, 0, 0
    order, lcp = suffix_array(ids)
    longest = np.maximum(lcp, np.concatenate((lcp[1:], [0])))
    top = int(longest.max())
    if top < min(window, least):
        return 0, 0, top, 0
    in_windows = order[longest >= window]
    repeats = longest >= least
    return (
        covered(in_windows, np.full(len(in_windows), window), n),
        covered(order[repeats], longest[repeats], n),
        top,
        maximal_repeats(ids, order, lcp, least),
    )


def rules(text: bytes) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, covered share,
    longest repeat, maximal repeats)."""
    ids = word_numbers(text)
    n = len(ids)
    spaces = sum(map(text.count, (bytes([c]) for c in SPACES)))
    chars = len(text) - len(text.translate(None, CONTINUATION_KEPT)) if text else 0
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = Counter(line for line in text.split(b"\n") if line.strip(SPACES))
    repeat, cover, longest, maximal = repetition(ids)
    failed = n < MIN_WORDS or 100 * repeat > 30 * n
    kept = not failed and cover <= MAX_COVERED * n and longest <= MAX_LONGEST
    share = cover / n if n else 0.0
    return n, chars - spaces, symbols, sum(lines.values()) - len(lines), repeat, failed, kept, share, longest, maximal


# bytes that begin a code point
CONTINUATION_KEPT = bytes(c for c in range(256) if not 128 <= c < 192)

FIELDS = [
    *(StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    StructField("base_failed", BooleanType()), StructField("kept", BooleanType()),
    StructField("covered_share", DoubleType()), StructField("longest_repeat", LongType()), StructField("n_maximal_repeats", LongType()),
]


def judge(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the base counts, the repetition figures and the verdict."""

    def make() -> Callable:
        def work(columns: list) -> list[tuple]:
            return [(doc_id, *rules(body)) for doc_id, body in zip(*columns)]

        return work

    schema = StructType([StructField(doc, df.schema[doc].dataType), *FIELDS])
    return scan(df.select(F.col(doc), utf8(text).alias("body")), make, schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return judge(documents(spark, sf_dir))
