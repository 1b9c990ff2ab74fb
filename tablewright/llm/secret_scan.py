"""Secret scan: rules find the sure secrets, a character convolutional network judges every other candidate.

Candidates are the rules' findings, passwords of ``scheme://user:password@host``, and what the rules leave of runs of
key characters: ``MIN_TOKEN`` or more with a digit, or ``MIN_LETTERS`` letters in a row.  Shorter words without a digit
are judged only as such passwords.

The network (numpy: embedding, one convolution, max over time, logistic output) reads the candidate with its
surrounding context.  A run is read whole: in overlapping windows of ``INSIDE`` bytes, and each part between ``/ . =``
by itself; its score is the highest, and the parts that reach the threshold are what is added.

It is trained on labelled findings: rule findings are positive; runs that are plainly something else (addresses, host
names, IPs, numbers) are negative; all others are unlabelled and only scored.  Training and calibration see what
scoring sees, all windows of a run: at most ``SAMPLE`` distinct windows of each kind and label train it, chosen by hash
from all documents; all labelled runs held out (30 %), scored in Spark by their highest window and counted by log odds
in steps of 0.001, calibrate the scores (Platt) and set, per kind, a threshold that keeps ``RECALL`` of the positives:
of those that do, the one halfway to the negatives (in log odds).  Candidates outside the rules' findings that reach
the threshold are added as kind ``model``.

Work is linear in the findings of a text.  Nulls: a null text is empty and has no findings; without findings of both
labels no model is trained and none are added.  Repeated rows are judged one by one; other columns pass through
``redact`` unchanged (``n_chars``, if there, is set to the new length of a text that changed).
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from tablewright.llm.common import cut, documents, scan, sliced, utf8
from tablewright.llm.spans import Span, digest, joined, replace, to_code_points
from tablewright.plans.ordered import hash_top_n

KINDS = ("assign", "access", "hex", "model")
MIN_TOKEN = 6
MIN_PART = 16
MIN_LETTERS = 16
SAMPLE = 3000
RECALL = 0.99
LEFT, INSIDE, RIGHT = 24, 48, 12

# The rules.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
KEYWORDS = (b"passw", b"secret", b"token", b"key")

TOKEN_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
TOKEN = re.compile(rb"[A-Za-z0-9+/_=.-]+")
DIGITS = re.compile(rb"[0-9]+")
LETTERS = re.compile(rb"(?<![A-Za-z])[A-Za-z]{%d,}" % MIN_LETTERS)
EITHER = re.compile(DIGITS.pattern + b"|" + LETTERS.pattern)
USER = re.compile(rb"[A-Za-z0-9._%+-]+")
PASSWORD = re.compile(rb"://[^\s:/@]*:([^\s/@]+)@")
PLAIN_NUMBER = re.compile(rb"[0-9.+/=_-]+")
PART = re.compile(rb"[^/.=]+")
HOST = re.compile(rb"(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}\.?")


def rule_spans(body: bytes) -> list[Span]:
    """The rules' findings, offsets in bytes."""
    found: list[Span] = []
    folded = body.lower()
    if any(k in folded for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(body) if len(m[2]) >= 6]
    if b"AKIA" in body:
        found += [("access", *m.span()) for m in ACCESS.finditer(body) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(body)]
    return found


def token_spans(body: bytes) -> list[tuple[int, int]]:
    """Maximal runs of key characters, ``MIN_TOKEN`` or longer with a digit or with ``MIN_LETTERS`` letters in a row."""
    out, end = [], 0
    some = len(body.translate(None, b"0123456789")) < len(body)
    for m in (EITHER if some else LETTERS).finditer(body):
        if m.start() < end:
            continue
        size = 256
        while True:
            low = max(0, m.start() - size)
            start = low + len(body[low : m.start()].rstrip(TOKEN_BYTES))
            if start > low or low == 0:
                break
            size *= 4
        end = TOKEN.match(body, m.start()).end()
        if end - start >= MIN_TOKEN:
            out.append((start, end))
    return out


def label_of(body: bytes, start: int, end: int) -> int | None:
    """0 for a run that is plainly no secret, else None."""
    run = body[start:end]
    if body[end : end + 1] == b"@":  # the user of an address, not a password
        host = TOKEN.match(body, end + 1)
        plain = USER.fullmatch(run) and host and HOST.fullmatch(host[0])
        return 0 if plain and body[max(0, start - 1) : start] != b":" else None
    if PLAIN_NUMBER.fullmatch(run) or HOST.fullmatch(run) and body[max(0, start - 1) : start] != b"@":
        return 0
    if body[max(0, start - 1) : start] == b"@" and HOST.fullmatch(run):
        low = max(0, start - 1 - 256)
        user = start - 1 - len(body[low : start - 1]) + len(body[low : start - 1].rstrip(TOKEN_BYTES + b"%"))
        return 0 if USER.fullmatch(body, user, start - 1) and body[max(0, user - 1) : user] != b":" else None
    return None


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans sorted, those that touch joined."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], z)
        else:
            out.append((a, z))
    return out


def free(start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the ``merged`` spans ``taken`` leave of a run."""
    out, i = [], bisect_right(taken, (start, start))
    i -= i > 0 and taken[i - 1][1] > start
    while i < len(taken) and taken[i][0] < end:
        out.append((start, taken[i][0]))
        start, i = max(start, taken[i][1]), i + 1
    return [(a, z) for a, z in [*out, (start, end)] if a < z]


def window_of(body: bytes, start: int, end: int) -> bytes:
    """Left context, the candidate's first bytes and right context, at fixed places."""
    left = body[max(0, start - LEFT) : start].rjust(LEFT, b"\0")
    inside = body[start : min(end, start + INSIDE)].ljust(INSIDE, b"\0")
    return left + inside + body[end : end + RIGHT].ljust(RIGHT, b"\0")


def pieces_of(body: bytes, start: int, end: int) -> list[tuple[int, int]]:
    """The run in overlapping windows that cover all of it, then its separated parts of ``MIN_PART`` or more alike."""
    parts = [(start, end)]
    if end - start > INSIDE:
        parts += [m.span() for m in PART.finditer(body, start, end) if MIN_PART <= m.end() - m.start() < end - start]
    out = []
    for a, z in parts:
        out += [(at, at + INSIDE) for at in range(a, z - INSIDE, INSIDE // 2)]
        out.append((max(a, z - INSIDE), z))
    return list(dict.fromkeys(out))


def reached(body: bytes, start: int, end: int, pieces: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pieces of a run, widened to the separated parts that their ends lie in, those that touch joined."""
    if end - start <= INSIDE:
        return [(start, end)] if pieces else []
    parts = [m.span() for m in PART.finditer(body, start, end)] if pieces else []
    first, last = [a for a, _ in parts], [z for _, z in parts]
    out: list[tuple[int, int]] = []
    for a, z in sorted(pieces):
        i, j = bisect_right(first, a) - 1, bisect_left(last, z)
        a = first[i] if i >= 0 and last[i] > a else a
        z = last[j] if j < len(parts) and first[j] < z else z
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], z)
        else:
            out.append((a, z))
    return out


def candidates(body: bytes) -> list[tuple[str, int, int, int | None]]:
    """(kind, start, end, label): the rules' findings, then runs that lie in none of them."""
    rules = rule_spans(body)
    out: list[tuple[str, int, int, int | None]] = [(k, a, z, 1) for k, a, z in rules]
    taken = merged([(a, z) for _, a, z in rules])
    if b"://" in body:
        words = [m.span(1) for m in PASSWORD.finditer(body)]
        words = [x for x in words if free(*x, taken) == [x]]
        out += [("model", a, z, None) for a, z in words]
        taken = merged(taken + words)
    for run in token_spans(body):
        for a, z in free(*run, taken):
            if (a, z) == run or z - a >= MIN_TOKEN and EITHER.search(body, a, z):
                out.append(("model", a, z, label_of(body, a, z)))
    return out


class CharNet:
    """Embedding, convolution, max over time, logistic output."""

    EMBED, FILTERS, WIDTH = 8, 24, 5

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        d = self.WIDTH * (self.EMBED + 1)
        self.p = {
            "emb": r.normal(0, 0.3, (129, self.EMBED)),
            "conv": r.normal(0, (2 / d) ** 0.5, (d, self.FILTERS)),
            "bias": np.zeros(self.FILTERS),
            "out": r.normal(0, 0.2, self.FILTERS),
            "one": np.zeros(1),
        }

    @staticmethod
    def codes(windows: list[bytes]) -> np.ndarray:
        return np.minimum(np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), -1), 128).astype(np.int64)

    def _columns(self, codes: np.ndarray) -> np.ndarray:
        n, length = codes.shape
        x = np.empty((n, length, self.EMBED + 1))
        x[:, :, :-1] = self.p["emb"][codes]
        x[:, :, -1] = 0  # marks the candidate's own characters
        x[:, LEFT : LEFT + INSIDE, -1] = codes[:, LEFT : LEFT + INSIDE] > 0
        view = np.lib.stride_tricks.sliding_window_view(x, self.WIDTH, axis=1)  # n, places, channels, width
        return view.transpose(0, 1, 3, 2).reshape(n, length - self.WIDTH + 1, -1)

    def logits(self, codes: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(codes), 256):
            act = np.maximum(self._columns(codes[at : at + 256]) @ self.p["conv"] + self.p["bias"], 0)
            out.append(act.max(axis=1) @ self.p["out"] + self.p["one"])
        return np.concatenate(out) if out else np.zeros(0)

    def fit(self, codes: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01) -> None:
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        r, step = np.random.default_rng(1), 0
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        for _ in range(epochs):
            order = r.permutation(len(y))
            for at in range(0, len(y), batch):
                pick, step = order[at : at + batch], step + 1
                for k, g in self._gradient(codes[pick], y[pick], weight[pick]).items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradient(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        cols = self._columns(codes)
        act = np.maximum(cols @ self.p["conv"] + self.p["bias"], 0)
        best = act.argmax(axis=1)  # n, filters
        top = np.take_along_axis(act, best[:, None, :], 1)[:, 0, :]
        err = (sigmoid(top @ self.p["out"] + self.p["one"]) - y) * weight / len(y)
        d_top = err[:, None] * self.p["out"] * (top > 0)
        n = len(y)
        picked = cols[np.arange(n)[:, None], best]  # n, filters, d
        d_conv = np.einsum("nf,nfd->df", d_top, picked)
        d_cols = d_top[:, :, None] * self.p["conv"].T  # n, filters, d
        d_chars = d_cols.reshape(n, self.FILTERS, self.WIDTH, self.EMBED + 1)[..., :-1]
        places = best[:, :, None] + np.arange(self.WIDTH)
        d_emb = np.zeros_like(self.p["emb"])
        np.add.at(d_emb, codes[np.arange(n)[:, None, None], places], d_chars)
        return {"emb": d_emb, "conv": d_conv, "bias": d_top.sum(0), "out": top.T @ err, "one": err.sum(keepdims=True)}


@dataclass
class Judge:
    """A trained network with its calibration and thresholds."""

    net: CharNet
    slope: float
    offset: float
    thresholds: dict[str, float]

    def scores(self, windows: list[bytes]) -> np.ndarray:
        if not windows:
            return np.zeros(0)
        z = [self.net.logits(CharNet.codes(windows[at : at + 4096])) for at in range(0, len(windows), 4096)]
        return sigmoid(self.slope * np.concatenate(z) + self.offset)


def train(samples: list[tuple[str, int, bytes]]) -> CharNet | None:
    """(kind, label, window) rows -> a network; None without both labels."""
    samples = sorted(samples, key=lambda s: (zlib.crc32(s[2]), s[2]))
    y = np.array([label for _, label, _ in samples], float)
    if len(np.unique(y)) < 2:
        return None
    net = CharNet()
    net.fit(CharNet.codes([w for _, _, w in samples]), y)
    return net


def calibrate(net: CharNet, counted: list[tuple[str, int, float, int]], recall: float = RECALL) -> Judge | None:
    """(kind, label, log odds, windows) rows of all held-out windows -> a judge; None without both labels."""
    counted = sorted(counted)
    kinds = np.array([k for k, *_ in counted])
    t, z, n = (np.array([r[i] for r in counted], float) for i in (1, 2, 3))
    if len(np.unique(t)) < 2:
        return None
    slope, offset = _platt(z, t, n)
    x = slope * z + offset

    def quantile(of: np.ndarray, q: float) -> float:
        order = np.argsort(x[of], kind="stable")
        upto = np.cumsum(n[of][order])
        return float(x[of][order][np.searchsorted(upto, np.floor(q * (upto[-1] - 1)), side="right")])

    low = quantile(t == 0, 0.999)

    def level(of: np.ndarray) -> float:
        high = quantile(of, 1 - recall)
        return float(sigmoid(np.array((high + low) / 2 if low < high else high)))

    positive = {k: (t == 1) & (kinds == k) for k in KINDS[:-1]}
    thresholds = {k: level(v if v.any() else t == 1) for k, v in positive.items()}
    return Judge(net, slope, offset, thresholds | {"model": level(t == 1)})


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _platt(z: np.ndarray, t: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic calibration with smoothed targets and a pull towards (1, 0): damped Newton steps."""
    n1, n0 = (n * t).sum(), (n * (1 - t)).sum()
    goal = np.where(t == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def loss(v: np.ndarray) -> float:
        x = v[0] * z + v[1]
        return float((n * (np.logaddexp(0, x) - goal * x)).sum() + 0.5 * (v[0] - 1) ** 2 + 0.5 * v[1] ** 2)

    v = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(v[0] * z + v[1])
        w, d = n * p * (1 - p), n * (p - goal)
        g = np.array([(d * z).sum() + v[0] - 1, d.sum() + v[1]])
        h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1]])
        step, part = np.linalg.solve(h, g), 1.0
        while part > 1e-4 and loss(v - part * step) > loss(v):
            part /= 2
        v = v - part * step
        if np.abs(part * step).max() < 1e-6:
            break
    return float(max(v[0], 1e-3)), float(v[1])


def learn(df: DataFrame, text: str = "text", sample: int = SAMPLE) -> Judge | None:
    """Train on at most ``sample`` distinct windows of each label and kind, chosen by hash; calibrate on all runs held out."""

    def make() -> Callable:
        def work(columns: list) -> list[tuple]:
            out = set()
            for body in columns[0]:
                for kind, a, z, label in candidates(body):
                    if label is not None:
                        out.add((kind, label, tuple(window_of(body, *p) for p in pieces_of(body, a, z))))
            return list(out)

        return work

    schema = StructType([
        StructField("kind", StringType()), StructField("label", LongType()), StructField("windows", ArrayType(BinaryType()))])
    found = cut(scan(df.select(utf8(text).alias("body")), make, schema).distinct())
    fits = F.pmod(F.xxhash64("windows"), F.lit(10)) < 7
    windows = found.where(fits).select("kind", "label", F.explode("windows").alias("window")).distinct()
    windows = cut(windows.withColumn("h", F.pmod(F.xxhash64("window"), F.lit(1 << 32))))
    picked = []
    for kind, label in [(k, 1) for k in KINDS[:-1]] + [(KINDS[-1], 0)]:
        part = windows.where((F.col("kind") == kind) & (F.col("label") == label))
        picked += hash_top_n(part, "h", ["window"], sample).collect()
    net = train([(r["kind"], r["label"], bytes(r["window"])) for r in picked])
    if net is None:
        return None
    sent = df.sparkSession.sparkContext.broadcast(net)

    def make_odds() -> Callable:
        def work(columns: list) -> list[tuple]:
            z = sent.value.logits(CharNet.codes([w for held in columns[2] for w in held]))
            first = np.cumsum([0, *(len(held) for held in columns[2])])[:-1]
            z = np.floor(np.clip(np.maximum.reduceat(z, first), -40, 40) * 1000).astype(np.int64)
            return list(zip(columns[0], columns[1], z.tolist()))

        return work

    odds = StructType([*schema.fields[:2], StructField("z", LongType())])
    counted = scan(found.where(~fits), make_odds, odds).groupBy("kind", "label", "z").count().collect()
    return calibrate(net, [(r["kind"], r["label"], r["z"] / 1000, r["count"]) for r in counted])


def judged(body: bytes, judge: Judge | None) -> tuple[list[Span], list[Span], list[float]]:
    """(rule spans, added spans, scores of both), offsets in bytes."""
    found = candidates(body)
    rules = [(k, a, z) for k, a, z, label in found if label == 1]
    if not judge or not found:
        return rules, [], [0.0] * len(found)
    pieces = [pieces_of(body, a, z) for _, a, z, _ in found]
    windows = {w: i for i, w in enumerate(dict.fromkeys(window_of(body, *p) for held in pieces for p in held))}
    every = judge.scores(list(windows)).tolist()
    added, scores = [], []
    for (k, a, z, label), held in zip(found, pieces):
        own = [every[windows[window_of(body, *p)]] for p in held]
        scores.append(max(own))
        if label != 1:
            high = [p for p, s in zip(held, own) if s >= judge.thresholds["model"]]
            added += [(k, *span) for span in reached(body, a, z, high)]
    return rules, added, scores


def find(df: DataFrame, judge: Judge | None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of rule findings, their digest, all spans, the candidates seen and the highest score."""
    sent = df.sparkSession.sparkContext.broadcast(judge)

    def make() -> Callable:
        def work(columns: list) -> list[tuple]:
            out = []
            for doc_id, body in zip(*columns):
                rules, added, scores = judged(body, sent.value)
                count = Counter(s[0] for s in rules)
                n = [count[k] for k in KINDS[:3]]
                every = to_code_points(body, rules + added)
                base = joined(every[: len(rules)], KINDS)
                out.append((doc_id, *n, digest(base), joined(every, KINDS), len(scores), max(scores, default=0.0)))
            return out

        return work

    schema = StructType([
        df.schema[doc], *(StructField(c, LongType()) for c in ("n_assign", "n_access", "n_hex")),
        StructField("base_sha256", StringType()), StructField("spans", StringType()),
        StructField("n_candidates", LongType()), StructField("top_score", DoubleType()),
    ])
    return scan(df.select(F.col(doc), utf8(text).alias("body")), make, schema)


def redact(df: DataFrame, judge: Judge | None, text: str = "text", length: str = "n_chars") -> DataFrame:
    """Every secret replaced by ``[SECRET]``; rows and columns stay."""
    sent = df.sparkSession.sparkContext.broadcast(judge)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            at = batch.schema.get_field_index(text)
            bodies = batch.column(at).cast(pa.binary()).to_pylist()
            changed = {}
            for i, body in enumerate(bodies):
                if body and (spans := [s for group in judged(body, sent.value)[:2] for s in group]):
                    changed[i] = replace(body, [(a, z, b"[SECRET]") for _, a, z in spans]).decode("utf-8", "replace")
            if changed:
                texts = batch.column(at).to_pylist()
                for i, new in changed.items():
                    texts[i] = new
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if (n := batch.schema.get_field_index(length)) >= 0:
                    sizes = batch.column(n).to_pylist()
                    for i, new in changed.items():
                        sizes[i] = len(new)
                    batch = batch.set_column(n, batch.schema.field(n), pa.array(sizes, batch.schema.field(n).type))
            yield batch

    return df.mapInArrow(run, df.schema)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    docs = documents(spark, sf_dir)
    return find(docs, learn(docs))
