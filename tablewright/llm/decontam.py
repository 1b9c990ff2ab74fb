"""Benchmark decontamination: a hash set of normalised benchmark n-grams, broadcast, against every training window.

Benchmark items become windows of ``width`` consecutive words (an item of fewer words is one window).  Each block of
items is broadcast as a word table plus a hash set of windows; documents are scanned window by window, a hit is
verified word for word, and hit words, items and spans come back per document.  A benchmark larger than
``block_bytes`` is scanned in several blocks, whose hits are merged, so what is broadcast never exceeds that bound.

Nulls: a null text has no words, a null item neither; a null item id is kept out of ``item_ids`` lists.  Repeated
rows are judged one by one.  Other columns of ``documents`` pass through ``remove`` unchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from tablewright.llm.common import cut, documents, fold, rolling, scan, segments, sliced, utf8

WIDTH = 10
BLOCK_BYTES = 32 << 20
BITMAP_BITS = 22


class WindowSet:
    """The windows of a block of items: all words as one array of numbers, and per window length the sorted hashes of
    its windows with their places, about 20 bytes a word.  A bitmap of hashes comes before the search, and what is
    found is compared word for word."""

    def __init__(self, items: list[tuple[object, bytes]], width: int):
        self.words: dict[bytes, int] = {}
        number = self.words.setdefault
        self.items = [item_id for item_id, _ in items]
        parts = []
        for _, text in items:
            words = fold(text or b"").split()
            parts.append(np.fromiter((number(w, len(self.words) + 1) for w in words), np.int32, len(words)))
        sizes = np.array([len(p) for p in parts], np.int64)
        self.flat = np.concatenate([*parts, np.zeros(0, np.int32)])
        self.starts = np.cumsum(sizes) - sizes
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({min(width, int(n)) for n in sizes if n}):
            self.tables[length] = self._table(length, np.minimum(sizes, width) == length, sizes)

    def _table(self, length: int, of: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bitmap, sorted hashes, places) of the windows of some items, each once per item."""
        inside = np.zeros(len(self.flat) + 1, np.int32)
        np.add.at(inside, self.starts[of], 1)
        np.add.at(inside, (self.starts + sizes - length + 1)[of], -1)
        places = np.flatnonzero(np.cumsum(inside[:-1]))
        hashes = rolling(self.flat.astype(np.uint64), length)[places]
        order = np.lexsort((places, hashes))
        hashes, places = hashes[order], places[order]
        # a window that comes again in its item is dropped where nothing else lies between the two
        again = (hashes[1:] == hashes[:-1]) & (self._owner(places[1:]) == self._owner(places[:-1]))
        again[again] = self._same(places[1:][again], places[:-1][again], length)
        keep = np.concatenate(([True], ~again))[: len(places)]
        hashes, places = hashes[keep], places[keep].astype(np.int32 if len(self.flat) < 1 << 31 else np.int64)
        bits = np.zeros(1 << BITMAP_BITS, bool)
        bits[self._slot(hashes)] = True
        return bits, hashes, places

    def _owner(self, places: np.ndarray) -> np.ndarray:
        """The number of the item that a place lies in; items without words share their start with the next one."""
        return np.searchsorted(self.starts, places, side="right") - 1

    def _same(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        out = np.ones(len(a), bool)
        for j in range(length):
            out &= self.flat[a + j] == self.flat[b + j]
        return out

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)

    def numbers(self, text: bytes) -> np.ndarray:
        """Word numbers of a text; 0 is a word that no item has."""
        get, zero = self.words.get, _Zero()
        parts = []
        for piece in segments(fold(text)):
            words = piece.split()
            parts.append(np.fromiter(map(get, words, zero), np.int32, len(words)))
        return np.concatenate(parts)

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, int, list]]:
        """(start, length, item ids) of every place where a window stands."""
        known_words = np.concatenate(([0], np.cumsum(ids > 0)))
        for length, (bits, known, places) in self.tables.items():
            if len(ids) < length:
                continue
            full = np.flatnonzero(known_words[length:] - known_words[:-length] == length)
            if not len(full):
                continue
            hashes = np.zeros(len(full), np.uint64)
            for j in range(length):
                hashes *= np.uint64(0x9E3779B97F4A7C15)
                hashes += ids[full + j].astype(np.uint64)
            maybe = bits[self._slot(hashes)]
            full, hashes = full[maybe], hashes[maybe]
            low, high = np.searchsorted(known, hashes, side="left"), np.searchsorted(known, hashes, side="right")
            for at, a, z in zip(full.tolist(), low.tolist(), high.tolist()):
                if a == z:
                    continue
                found = places[a:z]
                for j in range(length):
                    found = found[self.flat[found + j] == ids[at + j]]
                if len(found):
                    yield at, length, [self.items[i] for i in dict.fromkeys(self._owner(found).tolist())]


class _Zero:
    """Endless zeros, the default of dict.get in a map()."""

    def __iter__(self):
        return self

    def __next__(self):
        return 0


def item_blocks(bench: DataFrame, item: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The items in groups of about ``block_bytes`` of text, each to be broadcast by itself."""
    total = bench.agg(F.sum(F.octet_length(utf8(text)))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    if n == 1:
        return [bench]
    n = int(n * 1.2) + 1
    block = F.pmod(F.xxhash64(F.col(item), F.col(text)), F.lit(n))
    return [bench.where(block == i) for i in range(n)]


_SETS: dict[str, WindowSet] = {}


def _window_set(key: str, load: Callable[[], list], width: int) -> WindowSet:
    """One window set per Python worker."""
    if key not in _SETS:
        _SETS.clear()
        _SETS[key] = WindowSet(load(), width)
    return _SETS[key]


def _rows(block: DataFrame, item: str, text: str) -> list[tuple]:
    return [(r[0], bytes(r[1])) for r in block.select(F.col(item), utf8(text)).collect()]


SPANS = "hit_spans"


def scan_windows(
    df: DataFrame, bench: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``df``: doc, n_words, hit_spans (array of start,end word pairs, flat) and item_ids (array of strings)."""
    sc, state = df.sparkSession.sparkContext, None
    kind = df.schema[doc].dataType
    schema = StructType([
        StructField(doc, kind), StructField("n_words", LongType()), StructField(SPANS, ArrayType(LongType())),
        StructField("item_ids", ArrayType(StringType())),
    ])
    blocks = item_blocks(bench, item, item_text, block_bytes)
    several = len(blocks) > 1
    for block in blocks:
        sent = sc.broadcast(_rows(block, item, item_text))
        key = uuid.uuid4().hex
        inner = StructType(schema.fields + [StructField("_body", BinaryType())] * several)

        def make(sent=sent, key=key) -> Callable:
            found = _window_set(key, lambda: sent.value, width)

            def work(columns: list) -> list[tuple]:
                out = []
                for i, (doc_id, body) in enumerate(zip(columns[0], columns[1])):
                    spans, items = ([], set()) if len(columns) == 2 else (columns[2][i], set(columns[3][i]))
                    ids = found.numbers(body)
                    pairs = list(zip(spans[::2], spans[1::2]))
                    for start, length, owners in found.hits(ids):
                        pairs.append((start, start + length))
                        items.update(str(x) for x in owners if x is not None)
                    row = (doc_id, len(ids), [x for p in merge(pairs) for x in p], sorted(items))
                    out.append((*row, body) if several else row)
                return out

            return work

        if state is None:
            state = scan(df.select(F.col(doc), utf8(text).alias("_body")), make, inner)
        else:
            state = scan(cut(state).select(doc, "_body", SPANS, "item_ids"), make, inner)
    return state.drop("_body")


def merge(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open spans, in order."""
    out: list[list[int]] = []
    for start, end in sorted(pairs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def remove(
    df: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``df`` without any benchmark window; every column stays as it is."""
    sc = df.sparkSession.sparkContext
    for block in item_blocks(bench, item, item_text, block_bytes):
        sent = sc.broadcast(_rows(block, item, item_text))
        key = uuid.uuid4().hex

        def keep(batches: Iterator[pa.RecordBatch], sent=sent, key=key) -> Iterator[pa.RecordBatch]:
            found = _window_set(key, lambda: sent.value, width)
            for batch in sliced(batches):
                bodies = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
                clean = [b.as_py() is None or next(found.hits(found.numbers(b.as_py())), None) is None for b in bodies]
                yield batch.filter(pa.array(clean, pa.bool_()))

        df = df.mapInArrow(keep, df.schema)
    return df


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, 10-word windows."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = scan_windows(documents(spark, sf_dir), bench)
    pairs = F.transform(
        F.sequence(F.lit(0), F.greatest((F.size(SPANS) / 2).cast("int") - 1, F.lit(0))),
        lambda i: F.coalesce(F.get(SPANS, i * 2 + 1) - F.get(SPANS, i * 2), F.lit(0).cast("long")),
    )
    hit = F.aggregate(pairs, F.lit(0).cast("long"), lambda a, b: a + b)
    ids = F.array_join("item_ids", ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (hit > 0).alias("contaminated"), F.col(SPANS),
    ).withColumn(SPANS, F.array_join(SPANS, ","))
