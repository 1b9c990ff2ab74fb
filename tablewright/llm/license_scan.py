"""Licence scan: exact phrases, and fuzzy search of short notices.

Base labels: places where a phrase's words stand consecutively in the folded text (``common.fold``).  Fuzzy labels:
a notice may differ by up to one edit per ``CHARS_PER_EDIT`` characters.  With k edits allowed, its folded text is
split into k + 1 seeds, of which at least one must then stand exactly (pigeonhole).  One automaton finds all
seeds of all notices; around each seed the regex library's bounded-error matching verifies the edits and gives the
span and the number of edits.

Nulls: a null text has no words.  Repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tablewright.llm.common import documents, fold, scan, utf8

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Short notices in folded form, with the label of a match.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu": "gnu-notice",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee": "isc",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
CHARS_PER_EDIT = 10


class Notices:
    """The seeds of all notices in one automaton, and a bounded-error pattern for each notice."""

    def __init__(self, notices: dict[str, str] = NOTICES, chars_per_edit: int = CHARS_PER_EDIT):
        import ahocorasick
        import regex

        self.notices, seeds = [], {}
        for n, (notice, label) in enumerate(notices.items()):
            edits = len(notice) // chars_per_edit
            for at, end in self.split(len(notice), edits + 1):
                seeds.setdefault(notice[at:end], []).append((n, at))
            pattern = regex.compile(rf"(?e)(?<![^ ])(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}(?![^ ])")
            self.notices.append((label, len(notice), edits, pattern))
        self.automaton = ahocorasick.Automaton()
        for seed, places in seeds.items():
            self.automaton.add_word(seed, (len(seed), places))
        self.automaton.make_automaton()

    @staticmethod
    def split(length: int, parts: int) -> list[tuple[int, int]]:
        edges = [length * i // parts for i in range(parts + 1)]
        return list(zip(edges, edges[1:]))

    def search(self, words: str) -> list[tuple[str, int, int, int, int]]:
        """(label, start, end, edits, notice length) of each match in words joined by single spaces."""
        places: dict[int, list[tuple[int, int]]] = {}
        for end, (size, owners) in self.automaton.iter(words):
            for n, at in owners:
                _, length, edits, _ = self.notices[n]
                start = end + 1 - size - at
                places.setdefault(n, []).append((max(0, start - edits), start + length + edits))
        found = []
        for n, windows in places.items():
            label, length, edits, pattern = self.notices[n]
            done = 0
            for low, high in _merged(windows):
                for m in pattern.finditer(words, max(low, done), min(high, len(words))):
                    start, end = m.span()
                    lead = len(m[0]) - len(m[0].lstrip(" "))
                    found.append((label, start + lead, start + len(m[0].rstrip(" ")), sum(m.fuzzy_counts), length))
                    done = end
        return _best(found)


def _best(found: list[tuple[str, int, int, int, int]]) -> list[tuple[str, int, int, int, int]]:
    """Of matches that overlap, those with the smallest share of edits, then the longest."""
    kept: list[tuple[str, int, int, int, int]] = []
    spans: list[tuple[int, int]] = []  # of what is kept, apart from each other and in order
    for x in sorted(found, key=lambda x: (x[3] / x[4], -x[4], x[1], x[0])):
        i = bisect_left(spans, (x[1], x[2]))
        if (i == 0 or spans[i - 1][1] <= x[1]) and (i == len(spans) or x[2] <= spans[i][0]):
            kept.append(x)
            spans.insert(i, (x[1], x[2]))
    return sorted(kept, key=lambda x: (x[1], x[2], x[0]))


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(windows):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def phrase_places(words: bytes) -> list[tuple[int, int, str]]:
    """(first word, last word, label) of each phrase in folded words joined by single spaces."""
    found, held = [], b" " + words + b" "
    if b"license" not in words and b"cc by" not in words:
        return found
    for phrase, label in PHRASES.items():
        needle = b" " + phrase.encode() + b" "
        at, counted, first = held.find(needle), 0, 0
        while at >= 0:
            first += held.count(b" ", counted, at)
            counted = at
            found.append((first, first + phrase.count(" "), label))
            at = held.find(needle, at + 1)
    return found


def judge(body: bytes, notices: Notices) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, notice spans in words)."""
    split = fold(body).split()
    words = b" ".join(split)
    base = phrase_places(words)
    # one character a byte, so that offsets are those of the folded bytes
    fuzzy = notices.search(words.decode("latin-1")) if split else []
    base_labels = {x[2] for x in base}
    score = max([1.0 if base else 0.0, *(1 - e / n for _, _, _, e, n in fuzzy)])
    spans, counted, word = [], 0, 0
    for label, a, z, edits, _ in fuzzy:
        word += words.count(b" ", counted, a)
        counted = a
        spans.append(f"{label}:{word}:{word + words.count(b' ', a, z)}:{edits}")
    return (
        len(split), len(base), min((x[0] for x in base), default=None), max((x[0] for x in base), default=None),
        ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {x[0] for x in fuzzy})), score, ",".join(spans),
    )


FIELDS = [
    *(StructField(c, LongType()) for c in ("n_words", "n_base", "first_word", "last_word")),
    StructField("base_labels", StringType()), StructField("labels", StringType()),
    StructField("score", DoubleType()), StructField("notice_spans", StringType()),
]


def find(
    df: DataFrame, doc: str = "doc_id", text: str = "text", notices: dict[str, str] = NOTICES,
    chars_per_edit: int = CHARS_PER_EDIT,
) -> DataFrame:
    """Per row: the phrases' places and labels, all labels, the best score and label:first:last:edits spans (words)."""

    def make() -> Callable:
        held = Notices(notices, chars_per_edit)

        def work(columns: list) -> list[tuple]:
            return [(doc_id, *judge(body, held)) for doc_id, body in zip(*columns)]

        return work

    return scan(df.select(F.col(doc), utf8(text).alias("body")), make, StructType([df.schema[doc], *FIELDS]))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return find(documents(spark, sf_dir))
