"""Documents with every oddity: nulls in any column, empty and long texts, repeats, extra columns with clashing names."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

CLASHING = ["size", "shard", "slot", "score", "spans", "n_words", "_body", "body", "sid", "tokens", "node", "key", "kept", "lang_pred"]
SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    *(StructField(c, StringType()) for c in CLASHING),
])
LONG = "word another thing " * 150_000 + "é" * 1000 + " end. " + "x" * 3_000_000
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from the old house near the river today"
TEXTS = [
    (1, PROSE), (1, PROSE), (1, PROSE), (2, PROSE), (None, PROSE), (3, None), (None, None), (4, ""), (5, " \n\t "),
    (6, "one"), (7, "!!! ??? ..."), (8, LONG), (9, PROSE.upper()), (10, "día señor mañana " * 30), (11, "\x00\x1c\x85 a"),
    (12, "日本語 テキスト 中文"), (2, "another text for the same id"),
]


def odd_documents(spark):
    rows = [(i, t, None if i == 3 else "es" if i == 10 else "en", None, 0, *("junk",) * len(CLASHING)) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def saved(df, folder, **tables):
    """A data folder with ``documents`` and other tables."""
    for name, table in {"documents": df, **tables}.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
