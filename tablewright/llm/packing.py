"""Lexical retrieval packing into sequences of at most ``WINDOW`` tokens.

Each input partition is cut into index shards of about ``SHARD_TOKENS`` tokens, in row order.  A shard's BM25
inverted index (terms are token ids) returns, for a seed document, its unused neighbours, best first; they fill
the seed's window greedily.  The document that overflows the window is cut there: its rest opens the next window and it
becomes the next seed, so full windows have no padding.  The last, unfinished window of a shard goes on in the
next one; only the last window of a partition can be short.

Nothing is shuffled and a task holds one shard, whatever the table's size and however often a text repeats.  A retried
task repeats its windows exactly: sequence ids are made of the partition number and a counter.

Ids come from the ``tokenizers`` library, one whitespace-free chunk at a time and remembered: the tokenizer drops
white space and never joins across it, so the ids of a text are those of its chunks in a row.  A null text is empty:
its document is the end id alone.  Repeated rows are packed one by one; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tablewright.llm.common import documents, sliced, utf8
from tablewright.llm.quality_rules import pieces

TOKENIZER = "word_bpe_49k.json"
END = 2
WINDOW = 4096
SHARD_TOKENS = 1_000_000
BLOCK = 400
K1, B = 1.2, 0.75
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# letters of ASCII and Latin-1
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


class Ids:
    """Chunk -> ids as little-endian uint32 bytes; the two latest generations of chunks are remembered."""

    LIMIT = 300_000

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.marks = {m: self._encode([m])[0] for m in (b".", b",")}

    def _encode(self, chunks: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in chunks], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        """Chunks of letters alone are one piece each, whose last id ends a word: many go through in one string."""
        lines = [b" ".join(words[at : at + 128]).decode() for at in range(0, len(words), 128)]
        if not lines:
            return []
        found = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u4") for e in found])
        edges, raw = [0, *((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()], ids.tobytes()
        return [raw[a:z] for a, z in zip(edges, edges[1:])] if len(edges) == len(words) + 1 else self._encode(words)

    def learn(self, chunks: set[bytes]) -> None:
        """Make sure that all chunks are known."""
        if len(self.known) > self.LIMIT:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        marked, bare = [], []
        for c in chunks.difference(known):
            if (held := older.get(c)) is not None:
                known[c] = held
            elif c[-1] in b".," and len(c) > 1 and (48 <= c[-2] <= 57 or 97 <= c[-2] <= 122):
                marked.append(c)  # a mark after a letter or digit is a piece of its own
            else:
                bare.append(c)
        for c in {c[:-1] for c in marked}.difference(known, bare):
            if (held := older.get(c)) is not None:
                known[c] = held
            else:
                bare.append(c)
        words = [c for c in bare if LETTERS.fullmatch(c)]
        known.update(zip(words, self._encode_words(words)))
        other = list(set(bare).difference(words))
        known.update(zip(other, self._encode(other)))
        known.update([(c, known[c[:-1]] + self.marks[c[-1:]]) for c in marked])

    def of(self, bodies: list[bytes]) -> list[np.ndarray]:
        """Each text's ids with the end id."""
        split = [[p.split() for p in pieces(b.translate(_LOWER))] for b in bodies]
        chunks: set[bytes] = set()
        for parts in split:
            chunks.update(*parts)
        self.learn(chunks)
        get, end = self.known.__getitem__, np.array([END], "<u4").tobytes()
        return [np.frombuffer(b"".join([*(b"".join(map(get, p)) for p in parts), end]), "<u4") for parts in split]


_IDS: dict[str | None, Ids] = {}


def _ids(path: str | None) -> Ids:
    """One tokenizer with its memory per Python worker."""
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


class Index:
    """BM25 over the documents of a shard."""

    def __init__(self, docs: list[np.ndarray]):
        terms, counts = zip(*(np.unique(d, return_counts=True) for d in docs))
        self.terms = terms
        sizes = np.array([len(t) for t in terms])
        lengths = np.array([len(d) for d in docs], float)
        term, tf = np.concatenate(terms).astype(np.int64), np.concatenate(counts).astype(float)
        doc = np.repeat(np.arange(len(docs)), sizes)
        order = np.argsort(term, kind="stable")
        self.df = np.bincount(term)
        self.first = np.concatenate(([0], np.cumsum(self.df)))[:-1]
        idf = np.maximum(np.log((len(docs) - self.df + 0.5) / (self.df + 0.5)), 0)
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / lengths.mean()))
        self.doc, self.weight, self.idf, self.n = doc[order], weight[order], idf, len(docs)

    def scores(self, seed: int) -> np.ndarray:
        t = self.terms[seed]
        t = t[self.idf[t] > 0]  # a term in half of the documents weighs nothing
        many = self.df[t]
        if not many.sum():
            return np.zeros(self.n)
        at = np.repeat(self.first[t] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        return np.bincount(self.doc[at], self.weight[at], minlength=self.n)


class Packer:
    """Fills windows; a window's pieces come out when it is full or at the end."""

    def __init__(self, partition: int, window: int):
        self.window, self.next_id, self.room = window, partition << 33, window
        self.open: list[tuple] = []
        self.done: list[tuple] = []

    def close(self) -> None:
        if self.open:
            held = self.window - self.room
            self.done += [(*piece, self.next_id, offset, held) for *piece, offset in self.open]
            self.next_id += 1
            self.open, self.room = [], self.window

    def place(self, doc_id: object, ids: np.ndarray) -> bool:
        """Put a document in; True if it filled a window."""
        at, filled = 0, False
        while at < len(ids):
            take = min(self.room, len(ids) - at)
            part = ids[at : at + take]
            self.open.append((doc_id, at, take, zlib.crc32(part.tobytes()), len(ids), part, self.window - self.room))
            at, self.room = at + take, self.room - take
            if not self.room:
                self.close()
                filled = True
        return filled

    def shard(self, doc_ids: list, docs: list[np.ndarray]) -> None:
        index, unused, following = Index(docs), np.ones(len(docs), bool), 0
        while following < len(docs):
            if not unused[following]:
                following += 1
                continue
            seed = following
            while seed is not None:
                if unused[seed]:
                    unused[seed] = False
                    self.place(doc_ids[seed], docs[seed])
                seed = self._neighbours(index.scores(seed), unused, doc_ids, docs)

    def _neighbours(self, scores: np.ndarray, unused: np.ndarray, doc_ids: list, docs: list) -> int | None:
        """Place unused neighbours until a window is full; the document that filled it is the next seed."""
        ranked = np.flatnonzero(unused & (scores > 0))
        for n in ranked[np.argsort(-scores[ranked], kind="stable")].tolist():
            unused[n] = False
            if self.place(doc_ids[n], docs[n]):
                return n
        return None


def pack(
    df: DataFrame, doc: str = "doc_id", text: str = "text", window: int = WINDOW, path: str | None = None,
    shard_tokens: int = SHARD_TOKENS, with_ids: bool = False,
) -> DataFrame:
    """One row per piece; ``sequence_tokens`` is what its window holds, ``with_ids`` adds the piece's ids."""
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens")
    fields = [df.schema[doc], *(StructField(c, LongType()) for c in names)]
    fields += [StructField("ids", ArrayType(IntegerType()))] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens, packer = _ids(path), Packer(TaskContext.get().partitionId(), window)
        doc_ids, docs, held, kind = [], [], 0, None

        def out() -> Iterator[pa.RecordBatch]:
            done, packer.done = packer.done, []
            if done:
                cols = list(zip(*done))
                arrays = [pa.array(cols[0], kind), *(pa.array(cols[i], pa.int64()) for i in (1, 2, 3, 4, 6, 7, 8))]
                if with_ids:
                    arrays.append(pa.array([p.tolist() for p in cols[5]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

        for batch in sliced(batches, BLOCK):
            kind = batch.schema.field(0).type
            doc_ids += batch.column(0).to_pylist()
            new = tokens.of(batch.column(1).to_pylist())
            docs += new
            held += sum(map(len, new))
            if held >= shard_tokens:
                packer.shard(doc_ids, docs)
                doc_ids, docs, held = [], [], 0
                yield from out()
        if docs:
            packer.shard(doc_ids, docs)
        packer.close()
        yield from out()

    return df.select(F.col(doc), utf8(text).alias("_body")).mapInArrow(run, StructType(fields))


def op3_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return pack(documents(spark, sf_dir))
