"""Language identification with bit-sliced Bloom filters of character n-grams.

Learning: for every language, the n-grams of one to four letters (with word edges) that at least ``MIN_SHARE`` of its
documents hold; the short ones carry scripts without spaces and short texts.  All languages share one table of ``2**BITS`` rows; each n-gram of a language sets that language's bit in
``HASHES`` rows, so the AND of an n-gram's rows is the bitmask of all languages that contain it.  Counting runs
in Spark (n-grams per block first, then a sum by n-gram); only the table's rows reach the driver, ``2**BITS`` bytes for
each eight languages.  No language is left out.

Prediction: every n-gram occurrence of the whole text is looked up; the popcount of each language's bit, less the
share expected from its filter's false positives, decides.  Ties go to the language with more learned documents, then
to the smaller name; a text with letters of which no n-gram is known gets the first language with score 0.
``settle`` lets the verdicts take effect on a table: texts without a letter go, and so do texts whose language is not
among the ``wanted`` ones, if those are given; a missing language is filled in.  The height of a score depends on
script, length and subject, so it's no ground to drop a text.

Nulls and odd input: a null text or one without a letter (by Unicode category; digits in circles, superscripts and
the like are none) is ``und`` with score 0; a null language is not learned from; without any learned language
everything is ``und``, and ``settle`` keeps what has a letter.  Texts of any length are worked through in pieces.
Repeated rows are judged one by one; other columns pass through ``settle`` unchanged.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tablewright.llm.common import crc_column, documents, mix, scan, sliced

BITS = 20
HASHES = 3
MAX_SIZE = 4
MIN_SHARE = 0.005
PIECE = 1 << 18
UNDETERMINED = "und"


_NOT_LETTERS = re.compile(r"[\W\d_]+")


@cache
def _numerals() -> tuple[re.Pattern, re.Pattern]:
    r"""Numerals that ``\w`` holds and ``\d`` doesn't (superscripts, digits in circles, fractions ..), by plane: a
    pattern of the first plane's characters alone is searched by a table."""
    held = [c for c in map(chr, range(128, sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal()]
    return tuple(re.compile(f"[{''.join(c for c in held if (c > chr(0xFFFF)) == beyond)}]") for beyond in (False, True))


def letters_of(text: str) -> str:
    """The text in lower case, its runs of what isn't a letter as one space each."""
    text = text.lower()
    if not text.isascii():
        near, beyond = _numerals()
        text = near.sub(" ", text)
        text = beyond.sub(" ", text) if max(text) > chr(0xFFFF) else text
    return _NOT_LETTERS.sub(" ", text).strip()


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of (document number, n-gram hash) over all n-gram occurrences of the texts' words."""
    held, owners, size = [], [], 0
    for number, text in enumerate(texts):
        body = text or ""
        for at in range(0, len(body), PIECE):
            # a piece starts where the last one ended; a word cut there yields two shorter words
            letters = letters_of(body[at : at + PIECE])
            if not letters:
                continue
            held.append(f" {letters} ")
            owners.append(number)
            size += len(letters) + 2
            if size >= PIECE:
                yield from _hashed(held, owners)
                held, owners, size = [], [], 0
    if held:
        yield from _hashed(held, owners)


def _hashed(held: list[str], owners: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    points = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    number = np.repeat(np.array(owners, np.int64), [len(x) for x in held])
    space = points == 32
    out_n, out_h = [], []
    value, inner = np.ones(len(points), np.uint64), np.zeros(len(points), bool)
    for size in range(1, MAX_SIZE + 1):
        m = len(points) - size + 1
        if m <= 0:
            break
        value = value[:m] * np.uint64(0x100000001B3) + points[size - 1 :]
        inner = inner[:m]
        if size > 2:
            inner = inner | space[size - 2 : size - 2 + m]
        # no n-gram spans two words: a space may only be its first or last point, and not both beside each other
        good = ~inner & ~(space[:m] & space[size - 1 :]) & (number[:m] == number[size - 1 :])
        out_n.append(number[:m][good])
        out_h.append(mix(value[good]))
    if any(map(len, out_n)):
        yield np.concatenate(out_n), np.concatenate(out_h)


def _rows_of(hashes: np.ndarray, bits: int, k: int) -> np.ndarray:
    """The k table rows of each n-gram, shape (k, n)."""
    first, second = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([((first + second * np.uint64(i)) & np.uint64((1 << bits) - 1)).astype(np.int64) for i in range(k)])


@dataclass
class Filters:
    """languages by index; table: uint8 (bytes, rows), bit l%8 of byte l//8 is language l; false_rate per language."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    def counts(self, texts: list[str | None], k: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams per text, hits per text and language)."""
        n, total = len(texts), np.zeros(len(texts))
        hits = np.zeros((n, self.table.shape[0] * 8))
        bits = int(self.table.shape[1]).bit_length() - 1
        unpacked = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(float)
        for number, hashes in grams(texts):
            total += np.bincount(number, minlength=n)
            rows = _rows_of(hashes, bits, k)
            low, high = int(number.min()), int(number.max()) + 1
            for b, plane in enumerate(self.table):
                masks = plane[rows[0]]
                for r in rows[1:]:
                    masks &= plane[r]
                joint = np.bincount((number - low) * 256 + masks, minlength=(high - low) * 256)
                hits[low:high, b * 8 : b * 8 + 8] += joint.reshape(-1, 256) @ unpacked
        return total, hits[:, : len(self.languages)]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        total, hits = self.counts(texts)
        true = np.maximum(hits - total[:, None] * self.false_rate, 0) / (1 - self.false_rate)
        best = true.argmax(axis=1)
        share = true[np.arange(len(texts)), best] / np.maximum(total, 1)
        return [
            (self.languages[b], float(min(1.0, s))) if has_letter(x) else (UNDETERMINED, 0.0)
            for x, b, s in zip(texts, best, share)
        ]


def learn(df: DataFrame, lang: str = "lang", text: str = "text", min_share: float = MIN_SHARE) -> Filters:
    """Filters from all rows with a non-null language.  Languages are ordered by learned documents, then name."""
    rows = df.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = [r["lang"] for r in sizes]
    if not languages:
        return Filters([], np.zeros((1, 1 << BITS), np.uint8), np.zeros(0))
    number = {name: i for i, name in enumerate(languages)}
    least = [max(1.0, min_share * r["count"]) for r in sizes]

    def make() -> Callable:
        def work(columns: list) -> list[tuple]:
            seen: dict[int, list] = {}
            for name, body in zip(*columns):
                if name in number:
                    seen.setdefault(number[name], []).append(body)
            out = []
            for i, texts in seen.items():
                pairs = [_distinct(n, h) for n, h in grams(texts)]
                if pairs:
                    values, counts = np.unique(np.concatenate(pairs), return_counts=True)
                    out += zip([i] * len(values), values.view(np.int64).tolist(), counts.tolist())
            return out

        return work

    schema = StructType([StructField("l", LongType()), StructField("gram", LongType()), StructField("n", LongType())])
    frequent = scan(rows, make, schema).groupBy("l", "gram").agg(F.sum("n").alias("n"))
    limit = F.from_json(F.lit(json.dumps(least)), "array<double>")
    frequent = frequent.where(F.col("n") >= limit[F.col("l").cast("int")]).select("l", "gram")

    def make_rows() -> Callable:
        def work(columns: list) -> list[tuple]:
            held = _rows_of(np.array(columns[1], np.int64).view(np.uint64), BITS, HASHES)
            byte = [x // 8 for x in columns[0]]
            bit = [1 << x % 8 for x in columns[0]]
            return [x for r in held.tolist() for x in zip(r, byte, bit)]

        return work

    place = StructType([StructField(c, LongType()) for c in ("row", "byte", "bits")])
    # at most 2**BITS rows for each eight languages
    filled = scan(frequent, make_rows, place, rows=50_000).groupBy("row", "byte").agg(F.bit_or("bits").alias("bits"))
    held = filled.toArrow()
    table = np.zeros((-(-len(languages) // 8), 1 << BITS), np.uint8)
    table[held["byte"].to_numpy(), held["row"].to_numpy()] = held["bits"].to_numpy()
    fill = np.array([(table[i // 8] >> i % 8 & 1).mean() for i in range(len(languages))])
    return Filters(languages, table, np.minimum(fill**HASHES, 0.99))


def _distinct(number: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The hashes, each once per document."""
    order = np.lexsort((hashes, number))
    n, h = number[order], hashes[order]
    return h[np.concatenate(([True], (n[1:] != n[:-1]) | (h[1:] != h[:-1])))]


def predict(df: DataFrame, filters: Filters, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with lang_pred and score."""
    sent = df.sparkSession.sparkContext.broadcast(filters)

    def make() -> Callable:
        known = sent.value

        def work(columns: list) -> list[tuple]:
            return [(*row, *p) for *row, p in zip(*columns[:-1], known.predict(columns[-1]))]

        return work

    fields = [df.schema[c] for c in keep]
    schema = StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return scan(df.select(*keep, F.col(text).alias("_text")), make, schema, rows=500)


def settle(
    df: DataFrame, filters: Filters, text: str = "text", lang: str = "lang", wanted: Sequence[str] | None = None
) -> DataFrame:
    """The rows whose language is determined (and ``wanted``, if given), with a missing language filled in."""
    sent = df.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in sliced(batches):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            if not known.languages:
                yield batch.filter(pa.array(map(has_letter, texts), pa.bool_()))
                continue
            found = known.predict(texts)
            at = batch.schema.get_field_index(lang)
            field = batch.schema.field(at)
            held = [own if own is not None else name for own, (name, _) in zip(batch.column(at).to_pylist(), found)]
            batch = batch.set_column(at, field.with_nullable(True), pa.array(held, field.type))
            keeps = [name != UNDETERMINED and (wanted is None or name in wanted) for name, _ in found]
            yield batch.filter(pa.array(keeps, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def held_out(doc: str = "doc_id") -> Column:
    return crc_column(doc) % 4 == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learned from those that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text", held_out().alias("held_out"))
    filters = learn(docs.where(~F.col("held_out")))
    return predict(docs, filters, ["doc_id", "held_out"])
