"""Corpus-level text operators.

Documents stay rows; tokens are exploded only where a corpus statistic
needs them, and every statistic is a partial (map-side) aggregation, so a
term that appears in a third of all tokens is pre-combined before any
shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import text as tf
from tablewright.functions.stemming import with_stem
from tablewright.plans.ordered import ordinal
from tablewright.plans.parallel import spread
from tablewright.session import ensure_checkpoint_dir


# width of a model's input vectors
MAX_VECTOR_TERMS = 2_000_000
# terms that tasks look up in memory, and the bytes of the longest of them: 25 MB at most
HOT_TERMS = 100_000
HOT_TERM_BYTES = 256
# rows that a task works on at once
BLOCK_ROWS = 1000


# T7
def clean_text(
    df: DataFrame,
    text_col: str = "text",
    out: str = "tokens",
    stopwords: bool = True,
    stemming: bool = True,
    lower_first: bool = False,
    digits: str = "line",
    keep_text: bool = True,
) -> DataFrame:
    """Contractions, digits, punctuation, lower-case split, stop words, stems.

    Without ``keep_text`` the text goes as soon as it is split, so it is in none of the rows that are written on the way.

    The default order (contractions before lower-casing; a digit masks the
    rest of its line) reproduces the reference's cleaning.  ``lower_first``
    and ``digits='token'`` are the corrected variants.
    """
    df = spread(df)  # regex cleaning is CPU-bound: at least one task per core
    c = F.col(text_col)
    if lower_first:
        c = F.lower(c)
    c = tf.expand_contractions(c)
    c = tf.mask_digits(c) if digits == "line" else F.regexp_replace(c, "[0-9]+", tf.DIGITS_WORD)
    c = tf.strip_punctuation(c)
    toks = tf.normalize_ws_lower(c)
    gone = [] if keep_text or out == text_col else [text_col]
    if not stopwords:
        res = df.withColumn(out, toks).drop(*gone)
        return stem_tokens(res, out) if stemming else res
    # StopWordsRemover tests membership in a hash set (one lookup per token)
    tmp = df.withColumn("_tw_raw_tokens", toks).drop(out)
    remover = StopWordsRemover(inputCol="_tw_raw_tokens", outputCol=out, stopWords=list(tf.STOPWORDS), caseSensitive=True)
    res = remover.transform(tmp).drop("_tw_raw_tokens", *gone)
    return stem_tokens(res, out) if stemming else res


# T6
def stem_tokens(df: DataFrame, tokens_col: str, out: str | None = None) -> DataFrame:
    """English (Porter2) stem of every token; ``out`` is the tokens' column by default.

    Every distinct term is stemmed once, by column expressions (``functions.stemming``), and the stems that differ
    from their term come back to the rows (``_looked_up``).  The rows are written once: they are read for the terms
    and for the result.
    """
    out = out or tokens_col
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.checkpoint(eager=True)
    counts = _terms(rows, tokens_col).select("term", "n")
    # written before the filter, which would evaluate the whole chain again, and before the sampling of the order
    stems = with_stem(counts).checkpoint(eager=True).where(F.col("stem") != F.col("term"))
    ranked = ordinal(stems, [F.col("n").desc(), F.col("term").asc()], out="_rk").withColumn("_rk", F.col("_rk") - 1)
    fields = [*df.schema.fields] if out in df.columns else [*df.schema.fields, T.StructField(out, df.schema[tokens_col].dataType)]
    names = [f.name for f in fields]

    def put(batch: pa.RecordBatch, at: np.ndarray, coded: pa.DictionaryArray, stem: pa.Array) -> pa.RecordBatch:
        held = pc.coalesce(stem, coded.dictionary).take(coded.indices)
        tokens = batch.column("_tw_tokens")
        ends = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=batch.num_rows)))).astype(np.int32)
        found = pa.ListArray.from_arrays(ends, held, mask=tokens.is_null())
        return pa.RecordBatch.from_arrays([found if c == out else batch.column(c) for c in names], names=names)

    return _looked_up(rows, tokens_col, ranked, "stem", "_rk", df.columns, put, T.StructType(fields))


def _terms(df: DataFrame, tokens_col: str, min_len: int = 0) -> DataFrame:
    """(term, n, docs): every term of ``min_len`` characters or more, its tokens and the rows that hold it.

    A task adds up each Arrow batch first, so a term is one row per batch, not one per token, before the aggregation.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(0)
            coded = _plain(tokens.flatten()).dictionary_encode()
            terms, code = coded.dictionary, pc.fill_null(coded.indices, -1).to_numpy()
            good = code >= 0
            rows, size = np.repeat(np.arange(len(tokens)), _lengths(tokens))[good], max(len(terms), 1)
            n = np.bincount(code[good], minlength=len(terms))
            docs = np.bincount(np.unique(rows * size + code[good]) % size, minlength=len(terms))
            found = pa.RecordBatch.from_arrays([terms, pa.array(n), pa.array(docs)], names=["term", "n", "docs"])
            yield found.filter(pc.greater_equal(pc.utf8_length(terms), min_len)) if min_len else found

    held = df.select(F.col(tokens_col).alias("_tw_t")).mapInArrow(counted, "term string, n long, docs long")
    return held.groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _plain(terms: pa.Array) -> pa.Array:
    return terms if terms.type == pa.string() else terms.cast(pa.string())


def _lengths(tokens: pa.Array) -> np.ndarray:
    """Tokens of each row; a null row has none."""
    return np.where(tokens.is_null().to_numpy(zero_copy_only=False), 0, pc.fill_null(pc.list_value_length(tokens), 0))


# T9
def count_vectorize(
    df: DataFrame,
    doc_col: str,
    tokens_col: str,
    max_df: float = 0.95,
    min_df: float = 2,
    max_features: int | None = 50_000,
    min_len: int = 2,
) -> DataFrame:
    """Vocabulary with document-frequency bounds and a size cap.

    Terms have ``min_len`` characters or more (two: the vectoriser's token rule).

    Returns (term, term_count, doc_freq, term_index); ``term_index`` is the
    alphabetical position, the slot order of the resulting count vectors.
    Fractions in ``max_df``/``min_df`` are shares of the documents, integers
    absolute counts.  The cap keeps the ``max_features`` most frequent terms
    (ties by term).
    """
    n_docs = df.count()  # a document is a row
    hi = max_df * n_docs if isinstance(max_df, float) else max_df
    lo = min_df * n_docs if isinstance(min_df, float) and min_df < 1 else min_df
    stats = _terms(df, tokens_col, min_len).select("term", F.col("n").alias("term_count"), F.col("docs").alias("doc_freq"))
    stats = stats.filter((F.col("doc_freq") >= F.lit(lo)) & (F.col("doc_freq") <= F.lit(hi)))
    if max_features:
        # distributed rank by frequency (no global top-n merge), then keep the cap
        ranked = ordinal(stats, [F.col("term_count").desc(), F.col("term").asc()], out="_tw_rk")
        stats = ranked.filter(F.col("_tw_rk") <= F.lit(int(max_features))).drop("_tw_rk")
        # at most max_features rows: a bounded single-task ranking
        return stats.withColumn("term_index", F.row_number().over(Window.orderBy("term")) - 1)
    return ordinal(stats, ["term"], out="term_index").withColumn("term_index", F.col("term_index") - 1)


def idf_table(vocab: DataFrame, n_docs: int) -> DataFrame:
    """Smoothed idf: ln((1 + n) / (1 + df)) + 1."""
    return vocab.withColumn(
        "idf", F.log((F.lit(1.0 + n_docs)) / (F.col("doc_freq") + F.lit(1.0))) + F.lit(1.0)
    )


def _looked_up(
    df: DataFrame, tokens_col: str, vocab: DataFrame, value: str, rank: str, keep: list[str], work: Callable, schema: T.StructType,
    hot_terms: int | None = None,
) -> DataFrame:
    """Rows to rows by ``work(batch, tokens, value of each token)``; a row stays a row, whatever its id.

    The ``hot_terms`` (by default ``HOT_TERMS``) first terms by ``rank`` (from 0) go to the tasks as one Arrow table.  Only if there are more,
    rows get a block of ``BLOCK_ROWS`` neighbours each, written once with a reliable checkpoint.  The other terms of a
    block, each once, are joined to their entries, which come back to the rows by the block (``cogroup``): a frequent
    term is as many rows as there are blocks, and no row is exploded into a shuffle.
    """
    spark = df.sparkSession
    entries = vocab.select("term", F.col(value).alias("value"), F.col(rank).alias("rank"))
    hot = (F.col("rank") < (HOT_TERMS if hot_terms is None else hot_terms)) & (F.octet_length("term") <= HOT_TERM_BYTES)
    held = entries.where(hot).select("term", "value").toArrow()  # so many terms of HOT_TERM_BYTES bytes at most
    cold = entries.where(~hot).select("term", "value")
    rows = df.select(*keep, F.col(tokens_col).alias("_tw_tokens"))
    sent = spark.sparkContext.broadcast((held["term"].combine_chunks(), held["value"].combine_chunks()))

    def one(batch: pa.RecordBatch, more: pa.Table | None = None) -> pa.RecordBatch:
        terms, values = sent.value
        tokens = batch.column("_tw_tokens")
        coded = _plain(tokens.flatten()).dictionary_encode()
        entry = pc.take(values, pc.index_in(coded.dictionary, terms))
        if more is not None and more.num_rows:
            place = pc.index_in(coded.dictionary, _plain(more["term"].combine_chunks()))
            entry = pc.coalesce(entry, pc.take(more["value"].combine_chunks(), place))
        return work(batch, np.repeat(np.arange(batch.num_rows), _lengths(tokens)), coded, entry)

    if cold.isEmpty():
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, BLOCK_ROWS):
                    yield one(whole.slice(at, BLOCK_ROWS))

        return rows.mapInArrow(run, schema)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The terms of each block that the tasks don't hold."""
        terms = sent.value[0]
        for batch in batches:
            block = batch.column("_tw_block").to_numpy()
            edges = np.flatnonzero(np.diff(block)) + 1 if len(block) else []
            for at, end in zip([0, *edges], [*edges, len(block)]):
                found = _plain(batch.column("_tw_tokens").slice(at, end - at).flatten()).unique().drop_null()
                found = found.filter(pc.is_null(pc.index_in(found, terms)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block[at] if len(block) else 0)), found], names=["_tw_block", "term"])

    ensure_checkpoint_dir(spark)
    rows = rows.withColumn("_tw_block", F.expr(f"monotonically_increasing_id() div {BLOCK_ROWS}")).checkpoint(eager=True)
    terms = rows.select("_tw_block", "_tw_tokens").mapInArrow(others, "_tw_block long, term string")
    found = terms.join(cold, "term").select("_tw_block", "term", "value")

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        held = left.combine_chunks().to_batches()  # entries belong to blocks that have rows
        return pa.Table.from_batches([one(batch, right) for batch in held])

    return rows.groupBy("_tw_block").cogroup(found.groupBy("_tw_block")).applyInArrow(both, schema)


# T10
def tfidf(
    df: DataFrame, doc_col: str, tokens_col: str, vocab: DataFrame, n_docs: int, max_vocab_rows: int | None = None
) -> DataFrame:
    """Long-form L2-normalised TF-IDF weights (doc, term, weight).

    A document is one row, whatever its id: rows that share an id are weighted by themselves, and rows with a null id
    stay.  Terms are counted, weighted and normalised in the row, against the vocabulary from ``count_vectorize`` of
    any size; ``max_vocab_rows`` terms are looked up in the task (``_looked_up``).
    """
    ranked = ordinal(idf_table(vocab, n_docs).select("term", "idf", "doc_freq"), [F.col("doc_freq").desc(), F.col("term").asc()], out="_rk")
    ranked = ranked.withColumn("_rk", F.col("_rk") - 1)

    def weigh(batch: pa.RecordBatch, rows: np.ndarray, coded: pa.DictionaryArray, idf: pa.Array) -> pa.RecordBatch:
        code = pc.fill_null(coded.indices, -1).to_numpy()
        known = pc.fill_null(idf, 0.0).to_numpy()
        good = code >= 0
        good[good] = known[code[good]] > 0
        size = max(len(known), 1)
        pair, tf = np.unique(rows[good] * size + code[good], return_counts=True)
        row, term = pair // size, pair % size
        w = tf * known[term] if len(known) else np.zeros(0)
        norm = np.sqrt(np.bincount(row, w * w, batch.num_rows))
        columns = [batch.column(doc_col).take(pa.array(row)), coded.dictionary.take(pa.array(term)), pa.array(w / norm[row])]
        return pa.RecordBatch.from_arrays(columns, names=[doc_col, "term", "weight"])

    out = T.StructType([df.schema[doc_col], T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    return _looked_up(df, tokens_col, ranked, "idf", "_rk", [doc_col], weigh, out, max_vocab_rows)


def _vector_model(entries: pa.Table, tokens_col: str, out: str) -> PipelineModel:
    """Counts, weights and normalises in the JVM.  The vocabulary gets there as one string, not term by term."""
    jvm = SparkContext._active_spark_context._jvm
    terms = entries["term"].to_pylist()
    cut = next(c for c in map(chr, range(1, 1 << 16)) if not any(c in t for t in terms))
    java = jvm.java.util.regex.Pattern.compile(cut, jvm.java.util.regex.Pattern.LITERAL).split(cut.join(terms), -1)
    cv = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", java)
    cv.setInputCol(tokens_col).setOutputCol("_tw_counts")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(entries["idf"].to_numpy()), inputCol="_tw_counts", outputCol="_tw_tfidf")
    return PipelineModel([cv, scale, Normalizer(p=2.0, inputCol="_tw_tfidf", outputCol=out)])


# T11
def encode_text_model(
    train: DataFrame, doc_col: str, tokens_col: str, out: str = "features", **vocab_params
) -> tuple[PipelineModel, DataFrame]:
    """Fit T9 + T10 on ``train`` and return a reusable vectoriser.

    The vocabulary (at most ``max_features`` terms) and its idf vector are the
    only things that reach the driver.
    """
    vocab = count_vectorize(train, doc_col, tokens_col, **vocab_params)
    held = vocab.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if held > MAX_VECTOR_TERMS:
        raise ValueError(f"{held} terms: vectors need a vocabulary of at most {MAX_VECTOR_TERMS}; set max_features")
    if not held:
        raise ValueError("no terms within the bounds: an empty vocabulary")
    entries = idf_table(vocab, train.count()).orderBy("term_index").select("term", "idf").toArrow()
    return _vector_model(entries, tokens_col, out), vocab


# T12 / L2
def build_vocabulary(df: DataFrame, tokens_col: str, first_id: int = 2) -> DataFrame:
    """(term, term_count, term_id): ids by descending count (ties by term) from ``first_id``.

    0 is kept for padding / truncated terms and 1 for unknown terms.
    """
    counts = _terms(df, tokens_col).select("term", F.col("n").alias("term_count"))
    ranked = ordinal(counts, [F.col("term_count").desc(), F.col("term").asc()], out="_rk")
    return ranked.select("term", "term_count", (F.col("_rk") + F.lit(first_id - 1)).alias("term_id"))


def rank_terms(vocab: DataFrame) -> DataFrame:
    """Terms by frequency descending with their 1-based rank."""
    ranked = ordinal(vocab.select("term", "term_count"), [F.col("term_count").desc(), F.col("term").asc()], out="rank")
    return ranked


# T13
def encode_sequence(
    df: DataFrame, doc_col: str, tokens_col: str, vocab: DataFrame, unknown_id: int = 1, out: str = "seq",
    hot_terms: int | None = None, first_id: int = 2, last: int | None = None,
) -> DataFrame:
    """Tokens -> ids in order; unknown terms -> ``unknown_id``.  ``last`` keeps only a document's last tokens.

    A document is one row, whatever its id: rows that share an id, and rows with a null one, keep their own tokens.
    Rows without tokens get an empty sequence; null tokens are left out.  Ids are dense from ``first_id`` in frequency
    order (``build_vocabulary``), so the most frequent terms are looked up in the task (``_looked_up``).
    """
    if last is not None:
        held = F.filter(F.col(tokens_col), lambda x: x.isNotNull())
        df = df.withColumn(tokens_col, F.slice(held, F.greatest(F.size(held) - int(last) + 1, F.lit(1)), int(last)))
    entries = vocab.select("term", F.col("term_id").cast("int").alias("term_id"), (F.col("term_id") - first_id).alias("_rk"))

    def encode(batch: pa.RecordBatch, rows: np.ndarray, coded: pa.DictionaryArray, ids: pa.Array) -> pa.RecordBatch:
        known = pc.fill_null(ids, unknown_id).to_numpy().astype(np.int32)
        code = pc.fill_null(coded.indices, -1).to_numpy()
        good = code >= 0
        ends = np.concatenate(([0], np.cumsum(np.bincount(rows[good], minlength=batch.num_rows)))).astype(np.int32)
        flat = known[code[good]] if len(known) else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays([batch.column(doc_col), pa.ListArray.from_arrays(ends, flat)], names=[doc_col, out])

    schema = T.StructType([df.schema[doc_col], T.StructField(out, T.ArrayType(T.IntegerType()))])
    return _looked_up(df, tokens_col, entries, "term_id", "_rk", [doc_col], encode, schema, hot_terms)


def sequence_matrix(df: DataFrame, seq_col: str, max_features: int, maxlen: int, out: str = "padded") -> DataFrame:
    """T14 then T15."""
    return df.withColumn(out, tf.pad_sequences(tf.truncate_vocab(seq_col, max_features), maxlen))

