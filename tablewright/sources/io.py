"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# S1 / S2
def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ";",
    header: bool = True,
    infer: bool = False,
    pin: T.StructType | None = None,
    mode: str = "PERMISSIVE",
    corrupt: str | None = None,
) -> DataFrame:
    """Delimited text with an explicit schema, or with inferred types pinned to ``pin``.

    ``corrupt`` names a further column that holds the whole line of a row which doesn't fit the schema (a value of
    another type, too few or too many fields) and is NULL for all others; without it such values become NULL unseen.
    ``quarantine`` and ``reject_report`` work on it.

    Inference is a full extra pass over the files; on large inputs give a
    schema.  ``pin`` casts the inferred columns to the declared types so the
    result schema is stable across files.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if corrupt is not None:
        if schema is None:
            raise ValueError("corrupt rows are those that don't fit a schema: give one")
        if corrupt in schema.names:
            raise ValueError(f"the schema has a column {corrupt!r} already")
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
        df = reader.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])).csv(path)
        # true of every row; it reads all fields, for a row's verdict would else depend on the columns that a query reads
        return df.where(F.pmod(F.hash(*schema.names), F.lit(1)) == 0)
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.option("inferSchema", infer).csv(path)
    if pin is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in pin.fields])
    return df


def quarantine(df: DataFrame, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, without the corrupt column; the rejected rows as they are)."""
    return df.where(F.col(corrupt).isNull()).drop(corrupt), df.where(F.col(corrupt).isNotNull())


def reject_report(df: DataFrame, corrupt: str) -> DataFrame:
    """(n_rows, n_good, n_rejected) of a table read with a corrupt column."""
    bad = F.col(corrupt).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~bad).alias("n_good"), F.count_if(bad).alias("n_rejected"))


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


# S3
def read_corpus(
    spark: SparkSession,
    path: str,
    doc_col: str = "doc_id",
    text_col: str = "text",
    label_col: str | None = None,
    subset: Column | None = None,
) -> DataFrame:
    """Labelled documents (doc_id, text, label) from Parquet; ``subset`` is a filter."""
    df = spark.read.parquet(path)
    cols = [F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text")]
    if label_col:
        cols.append(F.col(label_col).alias("label"))
    out = df.select(*cols)
    return out.filter(subset) if subset is not None else out


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, text)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


# S4
def preview(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in a stated order (reproducible, unlike ``take``)."""
    return df.orderBy(*order).limit(int(n))


# S5
def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


# S6
def schema_table(df: DataFrame) -> DataFrame:
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, name string, type string, nullable boolean")


# S7
def save_search(cv_model, path: str, results: DataFrame | None = None) -> None:
    """Persist a fitted search model and, optionally, its results table as Parquet."""
    cv_model.write().overwrite().save(f"{path}/model")
    if results is not None:
        results.write.mode("overwrite").parquet(f"{path}/results")


def load_search(spark: SparkSession, path: str, model_class=None):
    """Return (model, results DataFrame, or None if none were saved); an unreadable results folder is an error."""
    if model_class is None:
        from pyspark.ml.tuning import CrossValidatorModel as model_class  # noqa: N813
    model = model_class.load(f"{path}/model")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/results")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return model, spark.read.parquet(f"{path}/results") if there else None
