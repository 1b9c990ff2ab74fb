"""N-gram Jaccard join by chosen paths: pairs of texts whose sets of five-word shingles have Jaccard >= 0.8, and classes.

1. One scan hashes each text's shingle set (words: ``common.fold``; fewer than five words are one shingle) and embeds
   it as ``COORDINATES`` min-hash tokens.  Texts with equal sets are one set from here on.
2. Chosen paths: a run starts with all sets in one node.  A node samples some of the tokens' places (each with
   probability 1 / (threshold * places), one at least) and sends every set to a child for each sampled token, so sets
   that share the token meet.  Children of at most ``LEAF`` sets are compared by brute force.  In larger ones every
   set is compared with ``PIVOTS`` pivots, sets close to one stop there, and the others are split again on newly
   sampled tokens.  Enough runs are made that a pair at the threshold is met with probability ``RECALL``
   (``runs_for``).  Comparisons use the tokens, at a bar low enough (``CANDIDATE``) to keep every pair at the
   threshold; what they give are candidate edges, at most one per set and node.
3. The components of the candidate edges are candidate groups.  Within each, all pairs are compared exactly on their
   shingle sets (32-bit hashes); groups larger than ``BLOCK`` in pairs of blocks, one task each.  This counts every
   link and gives the final edges; their components are the classes.

Why stopping at a pivot loses no pair: if J(x, pivot) >= 0.75 and J(x, y) >= 0.8, the Jaccard distance's triangle
inequality gives J(y, pivot) >= 0.55, so y is a candidate of the same pivot (``PIVOT_CANDIDATE``).  A group of alike
texts, however large, thus ends at its first pivots.

Copies are counted, never paired.  Nothing is capped: a large group costs more tasks, not more memory in one.

Nulls: a null text, or one without words, has no shingles: it is alone in its class with no links.  Null ids are
allowed; a class's id is its smallest non-null doc id.  Repeated rows are copies.  Other columns are ignored by
``classes`` and pass through ``keep_one`` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tablewright.llm.common import WordHash, cut, documents, fold, mix, rolling, scan, segments, sliced, utf8
from tablewright.llm.components import components

WORDS = 5
THRESHOLD = 0.8
COORDINATES = 64
RECALL = 0.995
LEVELS = 3
LEAF = 1000
MAX_LEVELS = 12
CANDIDATE = 0.65
PIVOTS = 8
PIVOT_CANDIDATE = 0.45
STOP = 0.75
BLOCK = 1024
FILTER_BITS = 26
_SALTS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_SHIFTS = mix(np.arange(1001, COORDINATES + 1001, dtype=np.uint64))


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD, levels: int = LEVELS) -> int:
    """Runs needed to meet a pair at the threshold with the given probability after ``levels`` splits."""
    meet = threshold**levels  # one sampled token a level is the least
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def shingles(body: bytes, hashes: WordHash) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    parts = [hashes.array(p.split()) for p in segments(fold(body))]
    words = np.concatenate(parts) if len(parts) > 1 else parts[0]
    if not len(words):
        return words
    return np.unique(mix(rolling(words, min(WORDS, len(words)))))


def set_key(values: np.ndarray) -> bytes:
    """16 bytes that name a shingle set."""
    import xxhash

    return xxhash.xxh3_128_digest(values.tobytes())


def tokens_of(values: np.ndarray) -> np.ndarray:
    """Min-hash tokens, one for each place (uint64)."""
    best = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 4096):
        part = values[at : at + 4096]
        best = np.minimum(best, (part[None, :] * _SALTS[:, None] + _SHIFTS[:, None]).min(axis=1))
    return best


def sampled(node: int, threshold: float = THRESHOLD) -> np.ndarray:
    """The places that a node samples: the same for all its sets."""
    draw = mix(np.array([node % (1 << 64)], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(COORDINATES, dtype=np.uint64))
    chosen = np.flatnonzero(draw < np.uint64(int((1 << 64) / (threshold * COORDINATES))))
    return chosen if len(chosen) else np.array([int(draw.argmin())])


def children(node: int, places: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Child node numbers (int64) of a set that has ``tokens`` at ``places``."""
    seed = np.uint64(node % (1 << 64)) + places.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(mix(seed) + tokens.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)).view(np.int64)


def embed(df: DataFrame, doc: str, text: str, runs: int) -> DataFrame:
    """Per row: doc, sid (null without words), the tokens' low 16 bits, and the first nodes of all runs."""
    roots = [(int(r), sampled(int(r))) for r in mix(np.arange(1, runs + 1, dtype=np.uint64))]

    def make() -> Callable:
        hashes = WordHash()

        def work(columns: list) -> list[tuple]:
            out = []
            for doc_id, body in zip(*columns):
                values = shingles(body, hashes)
                if not len(values):
                    out.append((doc_id, None, None, None))
                    continue
                tokens = tokens_of(values)
                first = np.concatenate([children(r, places, tokens[places]) for r, places in roots])
                low = (tokens >> np.uint64(48)).astype(np.uint16)
                out.append((doc_id, set_key(values), low.tobytes(), first.tolist()))
            return out

        return work

    schema = StructType([
        StructField("doc", df.schema[doc].dataType), StructField("sid", BinaryType()),
        StructField("tokens", BinaryType()), StructField("nodes", ArrayType(LongType())),
    ])
    return scan(df.select(F.col(doc), utf8(text).alias("_body")), make, schema, rows=500)


class Union:
    """Disjoint sets of 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def grouped(work: Callable[[object, list[tuple]], list[tuple]], schema: StructType) -> Callable:
    """For mapInArrow over rows sorted by their first column: ``work(key, rows)`` for each run of equal keys."""
    arrow = pa.schema([(f.name, {"binary": pa.binary(), "bigint": pa.int64()}[f.dataType.simpleString()]) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if row[0] != key and rows:
                    out += work(key, rows)
                    rows = []
                key = row[0]
                rows.append(row[1:])
            if len(out) > 5000:
                yield flush()
                out = []
        if rows:
            out += work(key, rows)
        yield flush()

    return run


EDGE = StructType([StructField("a", BinaryType()), StructField("b", BinaryType())])


def _leaf(node: object, rows: list[tuple]) -> list[tuple]:
    """All pairs of a small node by their tokens; a spanning forest of those that may reach the threshold."""
    rows = sorted(dict(rows).items())
    if len(rows) < 2:
        return []
    held = np.frombuffer(b"".join(t for _, t in rows), np.uint16).reshape(len(rows), -1)
    union = Union(len(rows))
    for i in range(len(rows) - 1):
        alike = (held[i + 1 :] == held[i]).mean(axis=1)
        for j in np.flatnonzero(alike >= CANDIDATE):
            union.join(i, i + 1 + int(j))
    roots = [union.find(i) for i in range(len(rows))]
    return [(rows[i][0], rows[r][0]) for i, r in enumerate(roots) if i != r]


STEP = StructType([
    StructField("a", BinaryType()), StructField("b", BinaryType()), StructField("node", LongType())])


def _pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sid, tokens, pivots, pivots' tokens) -> candidate edges to the pivots, and child nodes of sets far from all."""
    places: dict[int, np.ndarray] = {}
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        nodes, sids, _, pivots, _ = (batch.column(i).to_pylist() for i in range(5))
        own = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(n, 1, -1)
        other = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint16).reshape(n, PIVOTS, -1)
        alike = (own == other).mean(axis=2)
        out, joined = [], {}
        for r in np.flatnonzero(alike.max(axis=1) >= PIVOT_CANDIDATE).tolist():
            near = np.flatnonzero(alike[r] >= PIVOT_CANDIDATE).tolist()
            union = joined.setdefault(nodes[r], Union(PIVOTS))
            for k in near:  # to one pivot, and to those that no earlier set has joined to it
                if k == near[0] or union.find(k) != union.find(near[0]):
                    union.join(k, near[0])
                    if (p := pivots[r][16 * k : 16 * k + 16]) != sids[r]:
                        out.append((sids[r], p, None))
        for r in np.flatnonzero(alike.max(axis=1) < STOP).tolist():
            if (node := nodes[r]) not in places:
                places[node] = sampled(node)
            out += [(sids[r], None, c) for c in children(node, places[node], own[r, 0][places[node]]).tolist()]
        columns = list(zip(*out)) if out else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.binary(), pa.int64()))], names=["a", "b", "node"])


def _ordered(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(F.col(key)).sortWithinPartitions(key)


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Edges (a, b) between sets (sid, tokens, nodes) that meet on a chosen path and look alike."""
    members = sets.select("sid", F.explode("nodes").alias("node"))
    tokens = sets.select(F.col("sid").alias("s"), "tokens")
    edges = leaves = None
    for level in range(MAX_LEVELS + 1):
        sizes = members.groupBy(F.col("node").alias("n")).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        met = members.join(sizes, F.col("node") == F.col("n")).select("node", "sid", "size")
        met = cut(met.join(tokens, F.col("sid") == F.col("s")).select("node", "sid", "tokens", "size"))
        small = met.where(F.col("size") <= LEAF).select("node", "sid", "tokens")
        leaves = small if leaves is None else leaves.unionAll(small)
        large = met.where(F.col("size") > LEAF)
        if not large.limit(1).count():
            break
        if level == MAX_LEVELS:  # the exact way for what is still large: all pairs, in pairs of blocks
            dealt = _block_pairs(large.withColumn("group", F.col("node")), LEAF)
            leaves = leaves.unionAll(dealt.select(F.col("key").alias("node"), "sid", "tokens"))
            break
        # one smallest hash each; a node may draw the same set twice
        picks = [F.min(F.struct(F.xxhash64("node", "sid", F.lit(i)).alias("h"), "sid", "tokens")).alias(f"p{i}") for i in range(PIVOTS)]
        drawn = large.groupBy(F.col("node").alias("n")).agg(*picks)
        every = range(PIVOTS)
        pivots = drawn.select(
            "n", F.concat(*[F.col(f"p{i}.sid") for i in every]).alias("pivots"),
            F.concat(*[F.col(f"p{i}.tokens") for i in every]).alias("pt"))
        paired = large.join(pivots, F.col("node") == F.col("n")).select("node", "sid", "tokens", "pivots", "pt")
        step = cut(paired.mapInArrow(_pivot, STEP))
        more = step.where(F.col("node").isNull()).select("a", "b")
        edges = more if edges is None else edges.unionAll(more)
        members = step.where(F.col("node").isNotNull()).select(F.col("a").alias("sid"), "node").distinct()
    compared = _ordered(leaves, "node").mapInArrow(grouped(_leaf, EDGE), EDGE)
    return compared if edges is None else edges.unionAll(compared)


def _block_pairs(df: DataFrame, block: int) -> DataFrame:
    """Deal the rows of each ``group`` of ``size`` to blocks, and every pair of blocks (one with itself too) to a ``key``."""
    n = F.ceil(F.col("size") / block).cast("long")
    own = df.withColumn("_n", n).withColumn("own", F.pmod(F.xxhash64("sid", F.lit(11)), F.col("_n")))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return other.withColumn("cross", (F.col("own") != F.col("other"))).withColumn(
        "key", F.xxhash64("group", low, high)).drop("_n", "other")


def _filter(sids: DataFrame) -> np.ndarray:
    """A Bloom filter of set keys with a fixed number of bits; when full it only lets more rows through."""
    mask = (1 << FILTER_BITS) - 1
    spots = F.array(*[_part(F.col("sid"), at) for at in (1, 5)])
    bits = sids.select(F.explode(spots).alias("v")).select(F.col("v").bitwiseAND(mask).alias("v"))
    words = bits.select(F.shiftright("v", 5).alias("w"), F.expr("shiftleft(1L, cast(v & 31 AS int))").alias("bit"))
    held = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2**(FILTER_BITS - 5) rows
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[held["w"].to_numpy()] = held["bits"].to_numpy().astype(np.uint32)
    return out


def _part(sid: Column, at: int) -> Column:
    return F.conv(F.hex(F.substring(sid, at, 4)), 16, 10).cast("long")


def _passes(held: np.ndarray, sid: bytes) -> bool:
    for at in (0, 4):
        v = int.from_bytes(sid[at : at + 4], "big") & ((1 << FILTER_BITS) - 1)
        if not held[v >> 5] >> np.uint32(v & 31) & np.uint32(1):
            return False
    return True


VERIFIED = StructType([
    StructField("sid", BinaryType()), StructField("root", BinaryType()), StructField("texts", LongType()),
    StructField("rows", LongType()),
])


def _verify(key: object, rows: list[tuple]) -> list[tuple]:
    """(sid, own block, cross, rows, set) of one pair of blocks: exact links, counted, and a spanning forest."""
    cross = rows[0][2]
    rows = sorted(rows, key=lambda r: r[0])
    sets = [np.frombuffer(r[4], np.uint32) for r in rows]
    size = np.array([len(s) for s in sets], np.int64)
    many, block = np.array([r[3] for r in rows], np.int64), np.array([r[1] for r in rows])
    n, union = len(rows), Union(len(rows))
    texts, linked = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for first, shared in _intersections(sets):
        last = first + len(shared)
        # Jaccard >= 4/5 as whole numbers: 5 * shared >= 4 * union
        total = size[first:last, None] + size[None, :] - shared
        link = shared * 5 >= 4 * total
        link[np.arange(last - first), np.arange(first, last)] = False
        if cross:
            link &= block[first:last, None] != block[None, :]
        texts[first:last] += link.sum(axis=1)
        linked[first:last] += (link * many).sum(axis=1)
        for i, j in zip(*np.nonzero(link)):
            if first + i < j:
                union.join(first + int(i), int(j))
    return [(r[0], rows[union.find(i)][0], int(texts[i]), int(linked[i])) for i, r in enumerate(rows)]


def _intersections(sets: list[np.ndarray], strip: int = 256, columns: int = 4096) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, shared counts with every set) for strips of rows."""
    n = len(sets)
    if n <= 12:
        shared = np.zeros((n, n), np.int64)
        for i in range(n):
            for j in range(i + 1, n):
                shared[i, j] = shared[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        yield 0, shared
        return
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    useful = count[number] > 1
    renumber = np.cumsum(count > 1) - 1
    owner, number = owner[useful], renumber[number[useful]]
    width = int((count > 1).sum())
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    edges = np.searchsorted(number, np.arange(0, width + columns, columns))
    for first in range(0, n, strip):
        last = min(n, first + strip)
        shared = np.zeros((last - first, n), np.float32)
        for k in range(len(edges) - 1):
            a, z = edges[k], edges[k + 1]
            dense = np.zeros((n, columns), np.float32)
            dense[owner[a:z], number[a:z] - k * columns] = 1
            shared += dense[first:last] @ dense.T
        yield first, np.rint(shared).astype(np.int64)


def shingle_sets(df: DataFrame, text: str, wanted: np.ndarray) -> DataFrame:
    """(sid, set as uint32 bytes) of the sets that pass the filter, each once."""
    sent = df.sparkSession.sparkContext.broadcast(wanted)

    def make() -> Callable:
        hashes, held = WordHash(), sent.value

        def work(columns: list) -> list[tuple]:
            out = {}
            for body in columns[0]:
                values = shingles(body, hashes)
                if len(values) and _passes(held, sid := set_key(values)) and sid not in out:
                    out[sid] = np.unique((values >> np.uint64(32)).astype(np.uint32)).tobytes()
            return list(out.items())

        return work

    schema = StructType([StructField("sid", BinaryType()), StructField("set", BinaryType())])
    found = scan(df.select(utf8(text).alias("_body")), make, schema, rows=500)
    return found.groupBy("sid").agg(F.first("set").alias("set"))


def classes(df: DataFrame, doc: str = "doc_id", text: str = "text", recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(rows: doc, sid; sets: sid, n_rows, min_doc, class_doc, class_sid, class_rows, n_texts, n_linked).

    ``n_texts`` counts the different texts linked to a set, ``n_linked`` their rows; copies are ``n_rows``.
    """
    embedded = cut(embed(df, doc, text, runs_for(recall)))
    rows = embedded.select("doc", "sid")
    worded = embedded.where(F.col("sid").isNotNull())
    firsts = [F.first(c).alias(c) for c in ("tokens", "nodes")]
    sets = cut(worded.groupBy("sid").agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc").alias("min_doc"), *firsts))
    groups = components(candidate_edges(sets))
    sizes = groups.groupBy(F.col("root").alias("r")).agg(F.count(F.lit(1)).alias("size"))
    counted = sets.select(F.col("sid").alias("s"), "n_rows")
    members = groups.join(sizes, F.col("root") == F.col("r")).join(counted, F.col("id") == F.col("s"))
    members = cut(members.select(F.col("id").alias("sid"), F.col("root").alias("group"), "size", "n_rows"))
    held = shingle_sets(df, text, _filter(members.select("sid"))).withColumnRenamed("sid", "t")
    full = members.join(held, F.col("sid") == F.col("t")).select("sid", "group", "size", "n_rows", "set")
    dealt = _ordered(_block_pairs(full, BLOCK).select("key", "sid", "own", "cross", "n_rows", "set"), "key")
    verified = cut(dealt.mapInArrow(grouped(_verify, VERIFIED), VERIFIED))
    links = verified.groupBy(F.col("sid").alias("v")).agg(F.sum("texts").alias("n_texts"), F.sum("rows").alias("n_linked"))
    labels = components(verified.where(F.col("sid") != F.col("root")).select(F.col("sid").alias("a"), F.col("root").alias("b")))
    linked = labels.join(links, F.col("id") == F.col("v")).select("id", "root", "n_texts", "n_linked")
    plain = sets.select("sid", "n_rows", "min_doc")
    all_sets = cut(plain.join(linked, F.col("sid") == F.col("id"), "left").drop("id"))
    joined = all_sets.where(F.col("root").isNotNull())
    best = joined.groupBy(F.col("root").alias("class_sid")).agg(
        F.min("min_doc").alias("class_doc"), F.sum("n_rows").alias("class_rows"))
    joined = joined.join(best, F.col("root") == F.col("class_sid"))
    alone = all_sets.where(F.col("root").isNull()).select(
        "sid", "n_rows", "min_doc", F.col("min_doc").alias("class_doc"), F.col("sid").alias("class_sid"),
        F.col("n_rows").alias("class_rows"), F.lit(0).cast("long").alias("n_texts"), F.lit(0).cast("long").alias("n_linked"))
    return rows, cut(joined.select(alone.columns).unionAll(alone))


def join_rows(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """One row per document: doc, class_id, n_links (rows), n_linked_texts, class_rows."""
    known = rows.where(F.col("sid").isNotNull()).join(sets.withColumnRenamed("sid", "s"), F.col("sid") == F.col("s"))
    known = known.select(
        "doc", F.col("class_doc").alias("class_id"), (F.col("n_rows") - 1 + F.col("n_linked")).alias("n_links"),
        F.col("n_texts").alias("n_linked_texts"), "class_rows",
    )
    blank = rows.where(F.col("sid").isNull()).select(
        "doc", F.col("doc").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_linked_texts"), F.lit(1).cast("long").alias("class_rows"))
    return known.unionAll(blank)


def keep_one(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` with one row, that of the smallest doc id, of each class of near duplicates.

    Rows whose set is certainly alone (by a Bloom filter of the others) never leave their task.
    """
    rows, sets = classes(df, doc, text)
    several = sets.where(F.col("class_rows") > 1)
    sent = df.sparkSession.sparkContext.broadcast(_filter(several.select("sid")))
    key, cols = "_sid", df.columns
    while key in cols:
        key = "_" + key

    def split(alone: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, held = WordHash(), sent.value
            for batch in sliced(batches):
                keys = []
                for body in batch.column(batch.schema.get_field_index(text)).cast(pa.binary()):
                    values = shingles(body.as_py() or b"", hashes)
                    sid = set_key(values) if len(values) else None
                    keys.append(sid if sid and _passes(held, sid) else None)
                if alone:
                    yield batch.filter(pa.array([k is None for k in keys], pa.bool_()))
                else:
                    batch = batch.append_column(key, pa.array(keys, pa.binary()))
                    yield batch.filter(pa.array([k is not None for k in keys], pa.bool_()))

        return run

    marked = df.mapInArrow(split(False), StructType([*df.schema.fields, StructField(key, BinaryType())]))
    # the row that stays of each class, and how many rows are just like it
    in_class = rows.join(several.select(F.col("sid").alias("s"), "class_sid"), F.col("sid") == F.col("s"))
    least = F.min(F.struct(F.col("doc").isNull().alias("nil"), "doc", "sid")).alias("m")
    stays = in_class.groupBy("class_sid").agg(least).select(F.col("m.doc").alias("d"), F.col("m.sid").alias("k"))
    many = in_class.groupBy(F.col("sid").alias("s2"), F.col("doc").alias("d2")).agg(F.count(F.lit(1)).alias("same"))
    stays = cut(stays.join(many, (F.col("k") == F.col("s2")) & F.col("d").eqNullSafe(F.col("d2"))).select("k", "d", "same"))
    sure = several.select(F.col("sid").alias("in_s"))
    hit = marked.join(stays, (F.col(key) == F.col("k")) & F.col(doc).eqNullSafe(F.col("d")))
    single = hit.where(F.col("same") == 1).select(cols)
    repeated = hit.where(F.col("same") > 1).groupBy(key).agg(F.first(F.struct(*[F.col(c) for c in cols])).alias("r"))
    passed = marked.join(sure, F.col(key) == F.col("in_s"), "left_anti").select(cols)
    once = df.mapInArrow(split(True), df.schema)
    return once.unionAll(single).unionAll(repeated.select("r.*")).unionAll(passed)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: class (smallest doc id) and number of linked documents."""
    rows, sets = classes(documents(spark, sf_dir))
    return join_rows(rows, sets).withColumnRenamed("doc", "doc_id")
