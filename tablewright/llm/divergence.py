"""Source divergence audit: how far each source's word frequencies lie from its neighbours' and its language's.

Counting is an Arrow compute pipeline inside ``mapInArrow``: ``ascii_lower``, ``split_pattern_regex``,
``dictionary_encode`` and hash ``group_by`` turn a block of texts into counts by language, source and term; a task adds
them up within ``HELD_ROWS`` rows before they leave.  Spark merges the partial counts in shards by language and term,
which hold all sources of a term beside each other, so document frequencies and the language's counts need no other
shuffle.  A second pass over the merged shards takes the totals of the groups and adds up chi-square-like terms
``floor((p - q)^2 / q)`` for all pairs of a language's sources as columns of integers.

Rates are integers, ``p = 1 + floor(SCALE * (count + 1) / (N + V))``: the long division goes three digits at a time,
so it is exact for totals up to 9e15, and ``p`` stays below 2e9, whose square fits.

The result holds all ordered pairs of a language's sources, as it must; sources are worked through ``BLOCK_SOURCES`` at
a time, so that a task's sums are bounded.  Totals reach the tasks in slices of at most ``MAX_GROUPS`` groups (more
only where one language alone has more sources).

Nulls: null text, lang and source are empty strings.  A group without terms takes part with counts of 0; a language
without kept terms has pairs of value 0.  Repeated rows are documents of their own; very long texts are one document
as any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cut, documents

MIN_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_BYTES = 8 << 20
HELD_ROWS = 400_000
BLOCK_SOURCES = 256
BLOCK_CELLS = 1 << 20
MAX_GROUPS = 100_000

_PARTIAL = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64()),
])


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """The batch's rows in blocks of about ``BLOCK_BYTES`` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64) // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
    for a, z in zip(cuts, cuts[1:]):
        if z > a:
            yield pa.Table.from_batches([batch.slice(a, z - a)])


def term_counts(block: pa.Table) -> pa.Table:
    """Counts and document counts by lang, source and term; a null term carries each group itself."""
    lists = pc.split_pattern_regex(pc.ascii_lower(block["text"].combine_chunks()), pattern=SEPARATORS)
    doc, term = pc.list_parent_indices(lists), pc.list_flatten(lists)
    held = pc.not_equal(pc.binary_length(term), 0)
    coded = pc.filter(term, held).dictionary_encode()
    rows = pa.table({"doc": pc.filter(doc, held), "code": coded.indices})
    rows = rows.group_by(["doc", "code"], use_threads=False).aggregate([([], "count_all")])
    groups = [block[c].combine_chunks().dictionary_encode() for c in ("lang", "source")]
    at = [pc.take(g.indices, rows["doc"]) for g in groups]
    rows = pa.table({"lang": at[0], "source": at[1], "code": rows["code"], "n": rows["count_all"]})
    rows = rows.group_by(["lang", "source", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    named = pa.table(
        [
            pc.take(groups[0].dictionary, rows["lang"]), pc.take(groups[1].dictionary, rows["source"]),
            pc.take(coded.dictionary, rows["code"]), rows["n_sum"], rows["n_count"],
        ],
        schema=_PARTIAL,
    )
    bare = block.select(["lang", "source"]).group_by(["lang", "source"], use_threads=False).aggregate([])
    nothing = pa.array(np.zeros(bare.num_rows, np.int64))
    bare = pa.table(
        [bare["lang"], bare["source"], pa.nulls(bare.num_rows, pa.string()), nothing, nothing], schema=_PARTIAL
    )
    return pa.concat_tables([named, bare])


def _merged(tables: list[pa.Table]) -> pa.Table:
    rows = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False)
    rows = rows.aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table([rows[c] for c in ("lang", "source", "term", "n_sum", "docs_sum")], schema=_PARTIAL)


def partial_counts(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Counts of each task: lang, source, term, n, docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for block in _blocks(batch):
                held.append(term_counts(block))
                if sum(t.num_rows for t in held) > 2 * HELD_ROWS:
                    held = [_merged(held)]
                    if held[0].num_rows > HELD_ROWS:
                        yield from held.pop().to_batches()
        if held:
            yield from _merged(held).to_batches()

    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for c, k in ((lang, "lang"), (source, "source"), (text, "text"))]
    return df.select(*empty).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def rate(count: Column, total: Column, scale: int = SCALE) -> Column:
    """1 + floor(scale * count / total) for count <= total, exact: three decimal digits at a time."""
    out, rest = F.lit(0).cast("long"), count
    while scale > 1:
        step = min(scale, 1000)
        rest = rest * step
        out, rest, scale = out * step + _quotient(rest, total), F.pmod(rest, total), scale // step
    return out + 1


def _quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def rates(counts: np.ndarray, totals: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``rate`` for integer arrays."""
    out, rest = np.zeros(np.broadcast(counts, totals).shape, np.int64), counts
    while scale > 1:
        step = min(scale, 1000)
        rest = rest * step
        out, rest, scale = out * step + rest // totals, rest % totals, scale // step
    return out + 1


def merged_counts(df: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, n_lang) of all kept terms, in shards by lang and term; a null term carries each group."""
    sharded = partial_counts(df).repartition("lang", "term")
    merged = sharded.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    shard = Window.partitionBy("lang", "term")
    merged = merged.select("*", F.sum("docs").over(shard).alias("all_docs"), F.sum("n").over(shard).alias("n_lang"))
    kept = merged.where(F.col("term").isNull() | (F.col("all_docs") >= min_docs))
    # read three times below: totals, pairs and terms
    return cut(kept.select("lang", "source", "term", "n", "n_lang"))


def group_totals(counts: DataFrame) -> DataFrame:
    """(lang, source, n_group, n_all, v): the sums over kept terms and the number of kept terms of the language."""
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    terms = counts.where(F.col("term").isNotNull()).groupBy("lang").agg(F.countDistinct("term").alias("v"))
    sums = groups.groupBy("lang").agg(F.sum("n_group").alias("n_all")).join(terms, "lang", "left")
    return cut(groups.join(sums.select("lang", "n_all", F.coalesce("v", F.lit(0)).alias("v")), "lang"))


def pair_sums(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value): f summed over the terms, for all ordered pairs of a language's sources."""
    zero = totals.select("lang", "source").join(
        totals.select("lang", F.col("source").alias("item")), "lang"
    ).where(F.col("source") != F.col("item")).select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    sizes = totals.where("v > 0").groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    sizes = sizes.withColumn("blocks", F.ceil(F.col("sources") / BLOCK_SOURCES))
    rows = counts.where(F.col("term").isNotNull())
    before = Window.orderBy("lang").rowsBetween(Window.unboundedPreceding, -1)
    # one row a language: a window over that small table
    sliced = cut(sizes.withColumn("slice", F.floor(F.coalesce(F.sum("sources").over(before), F.lit(0)) / MAX_GROUPS)))
    summed = zero
    for number in [r[0] for r in sliced.select("slice").distinct().orderBy("slice").collect()]:
        # languages of at most MAX_GROUPS groups, or one
        of = F.broadcast(sliced.where(F.col("slice") == number))
        summed = summed.unionAll(_slice_sums(rows.join(of.select("lang", "blocks"), "lang"), totals.join(of, "lang")))
    return summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _slice_sums(rows: DataFrame, totals: DataFrame) -> DataFrame:
    known: dict[str, tuple] = {}
    for r in totals.orderBy("lang", "source").select("lang", "source", "n_group", "v").collect():
        names, sums, _ = known.setdefault(r["lang"], ([], [], r["v"]))
        names.append(r["source"])
        sums.append(r["n_group"] + r["v"])
    sent = rows.sparkSession.sparkContext.broadcast({k: (n, np.array(t, np.int64)) for k, (n, t, _) in known.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value
        places = {k: {s: i for i, s in enumerate(names)} for k, (names, _) in tables.items()}
        open_: tuple | None = None  # the language and block of sources in work
        sums = np.zeros((0, 0), np.int64)
        rest: tuple = ()  # term, places and counts of a term whose rows may go on

        def add(where: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
            """Add the terms numbered ``where`` (0, 0, 1, ..) with counts ``n`` in the sources ``at``."""
            if not len(where):
                return
            lang, block = open_
            held, total = np.zeros((int(where[-1]) + 1, sums.shape[1]), np.int64), tables[lang][1]
            held[where, at] = n
            p = rates(held + 1, total[None, :])
            for g in range(len(sums)):
                gap = p[:, block * BLOCK_SOURCES + g, None] - p
                sums[g] += (gap * gap // p).sum(axis=0)

        def result() -> pa.RecordBatch:
            lang, block = open_
            names = tables[lang][0]
            g, h = np.nonzero(sums)
            return pa.RecordBatch.from_arrays([
                pa.array([lang] * len(g), pa.string()), pa.array([names[block * BLOCK_SOURCES + i] for i in g], pa.string()),
                pa.array([names[i] for i in h], pa.string()), pa.array(sums[g, h], pa.int64()),
            ], names=["lang", "source", "item", "value"])

        for part in _runs(batches, {k: max(1, BLOCK_CELLS // len(names)) for k, (names, _) in tables.items()}):
            key = (part["lang"][0].as_py(), part["block"][0].as_py())
            if open_ != key:
                if open_:
                    add(*rest[1:])
                    yield result()
                open_, rest = key, ()
                size = len(tables[key[0]][0])
                sums = np.zeros((min(BLOCK_SOURCES, size - key[1] * BLOCK_SOURCES), size), np.int64)
            term, source = part["term"].dictionary_encode(), part["source"].dictionary_encode()
            place = np.array([places[key[0]][s] for s in source.dictionary.to_pylist()], np.int64)
            at, n = place[source.indices.to_numpy()], part["n"].to_numpy()
            # sorted, so the dictionary numbers the terms in their order
            where, names = term.indices.to_numpy().astype(np.int64), term.dictionary
            if rest:
                same = names[0].as_py() == rest[0]
                where = np.concatenate((rest[1], where + (not same)))
                at, n = np.concatenate((rest[2], at)), np.concatenate((rest[3], n))
            done = int(np.searchsorted(where, where[-1]))
            add(where[:done], at[:done], n[:done])
            rest = (names[-1].as_py(), np.zeros(len(where) - done, np.int64), at[done:], n[done:])
        if open_:
            add(*rest[1:])
            yield result()

    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    blocks = rows.select("lang", block, "term", "source", "n").repartition("lang", "block", "term")
    blocks = blocks.sortWithinPartitions("lang", "block", "term")
    return blocks.mapInArrow(run, "lang string, source string, item string, value long")


def _runs(batches: Iterator[pa.RecordBatch], most: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Sorted batches cut where the language or the block changes, and after ``most`` rows of a language."""
    for batch in batches:
        lang, block = batch.column("lang").dictionary_encode(), batch.column("block").to_numpy()
        codes = lang.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), batch.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            step = most[lang.dictionary[codes[a]].as_py()] if z > a else 1
            for i in range(a, z, step):
                yield batch.slice(i, min(step, z - i))


def term_values(counts: DataFrame, totals: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source has beyond its language's rate, the first ``top``."""
    # a hot source's terms aren't shuffled by it while the groups are few
    totals = F.broadcast(totals) if totals.count() <= MAX_GROUPS else totals
    rows = counts.where(F.col("term").isNotNull() & (F.col("n") > 0)).join(totals, ["lang", "source"])
    p = rate(F.col("n") + 1, F.col("n_group") + F.col("v")).alias("p")
    q = rate(F.col("n_lang") + 1, F.col("n_all") + F.col("v")).alias("q")
    rows = rows.select("lang", "source", F.col("term").alias("item"), p, q).where("p > q")
    gap = F.col("p") - F.col("q")
    rows = rows.select("lang", "source", "item", _quotient(gap * gap, F.col("q")).alias("value"))
    # tasks keep their own first ones before the shuffle (window group limit)
    return _ranked(rows).where(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(group))


def diverging(df: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    counts = merged_counts(df, min_docs)
    totals = group_totals(counts)
    columns = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    pairs = columns(_ranked(pair_sums(counts, totals)), "pair")
    return pairs.unionAll(columns(term_values(counts, totals, top), "term"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return diverging(documents(spark, sf_dir))
