"""Spans of a text, found in its UTF-8 bytes and reported in code points."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def to_code_points(body: bytes, spans: list[Span]) -> list[Span]:
    """The same spans with code-point offsets."""
    if body.isascii():
        return spans
    marks, at, points = {}, 0, 0
    for edge in sorted({e for s in spans for e in s[1:]}):
        points += len(body[at:edge].decode("utf-8", "replace"))
        marks[edge], at = points, edge
    return [(k, marks[a], marks[z]) for k, a, z in spans]


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then kind as listed."""
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2])))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def replace(body: bytes, spans: list[tuple[int, int, bytes]]) -> bytes:
    """Put each span's mark in its place; overlapping spans become one with the first one's mark."""
    out, at = [], 0
    for start, end, mark in sorted(spans):
        if start >= at:
            out += [body[at:start], mark]
        at = max(at, end)
    return b"".join([*out, body[at:]])
