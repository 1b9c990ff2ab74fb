"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SEGMENT_BYTES = 1 << 20
EXPAND = 65_536


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder; a local master without one gets a scratch folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="tw-ckpt-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def expand(placed: DataFrame, names: list[str], column: str) -> DataFrame:
    """One row for each of the ``_n`` numbers from ``_start``, in blocks that spread over tasks."""
    top = (F.col("_n") - 1) / EXPAND
    blocks = placed.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(top).cast("long"))))
    blocks = blocks.select(
        *names,
        (F.col("_start") + F.col("_block") * EXPAND).alias("_from"),
        F.least(F.lit(EXPAND).cast("long"), F.col("_n") - F.col("_block") * EXPAND).alias("_many"),
    )
    many = F.sequence(F.lit(0).cast("long"), F.col("_many") - 1)
    return blocks.withColumn("_i", F.explode(many)).select(*names, (F.col("_from") + F.col("_i")).alias(column))


def utf8(column: str) -> Column:
    """The text's UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def scan(
    df: DataFrame, make: Callable[[], Callable[[list], list[tuple]]], schema: StructType, rows: int = 500
) -> DataFrame:
    """Map blocks of at most ``rows`` rows to result tuples; ``make`` builds a task's worker function once."""
    names = df.columns
    arrow = pa.schema([(f.name, _arrow_type(f.dataType.simpleString())) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for block in sliced(batches, rows):
            out = work([block.column(i).to_pylist() for i in range(len(names))])
            columns = list(zip(*out)) if out else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that a worker turns few texts into Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(_arrow_type(name[6:-1]))
    return {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(),
    }[name]


# Words of lower-cased A-Z text: runs without ASCII separators.  In UTF-8 a byte table does both steps.
_ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def fold(text: bytes) -> bytes:
    """Lower-case A-Z and turn every ASCII character other than letters and digits into a space."""
    return text.translate(_ALNUM)


def segments(text: bytes, size: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """Cut folded text at spaces, so that word lists of very long texts stay small."""
    at = 0
    while len(text) - at > size:
        end = text.find(b" ", at + size)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def crc_of_id(doc_id: int | None) -> int:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode())


def crc_column(column: str) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


class WordHash(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolling(values: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Polynomial hash of every window of ``width`` values (uint64, modulo 2**64)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= np.uint64(base)
        out += values[j : j + n]
    return out


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (splitmix64 finaliser)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z

