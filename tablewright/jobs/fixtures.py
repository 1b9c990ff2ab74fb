"""Stand-in inputs derived from the driver tables (see FIXTURES.md §3).

Each fixture exists twice: as a Spark DataFrame and as a DuckDB ``WITH``
clause, written side by side so the oracle queries read exactly the same
derived rows.  The driver tables hold no NULLs, so missing values are
injected identically on both sides with ``nullif``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOAN_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LOAN_NUMERIC = ["l_quantity", "l_extendedprice", "l_tax", "l_discount", "unit_price"]
LOAN_CATEGORICAL = ["l_returnflag", "l_linestatus"]
# label threshold on the discounted price (learnable, about half positive)
LOAN_LABEL_THRESHOLD = 47000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loan_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *LOAN_KEY,
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        F.when(F.col("l_discount") != 0.0, F.col("l_discount")).alias("l_discount"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        "l_returnflag",
        "l_linestatus",
        F.when(F.col("l_extendedprice") * (1 - F.col("l_discount")) > LOAN_LABEL_THRESHOLD, "high")
        .otherwise("low")
        .alias("status"),
    )


LOAN_SQL = f"""loan AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax,
         nullif(l_discount, 0.0) AS l_discount,
         CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
         l_returnflag, l_linestatus,
         CASE WHEN l_extendedprice * (1 - l_discount) > {LOAN_LABEL_THRESHOLD} THEN 'high' ELSE 'low' END AS status
  FROM lineitem)"""


def levels_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("nation"), "c_mktsegment", "c_acctbal")


LEVELS_SQL = """levels AS (
  SELECT c_custkey, 'N' || CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment, c_acctbal FROM customer)"""


def housing_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order aggregates standing in for district totals.

    ``price_k`` (order price in thousands) is the stated label; it carries no
    signal in the driver data, so the regressors also get ``value_k`` (the
    order's line value in thousands), which the per-line features explain.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    agg = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("total_qty"),
        F.sum("l_discount").alias("total_disc"),
        F.sum("l_tax").alias("total_tax"),
        F.sum("l_extendedprice").alias("total_value"),
    )
    j = o.join(agg, o["o_orderkey"] == agg["l_orderkey"], "inner")
    return j.select(
        "o_orderkey",
        "n_lines",
        "total_qty",
        F.try_divide(F.col("total_qty"), F.col("n_lines").cast("double")).alias("qty_per_line"),
        F.try_divide(F.col("total_disc"), F.col("n_lines").cast("double")).alias("disc_per_line"),
        F.try_divide(F.col("total_tax"), F.col("n_lines").cast("double")).alias("tax_per_line"),
        (F.col("o_totalprice") / 1000.0).alias("price_k"),
        (F.col("total_value") / 1000.0).alias("value_k"),
    )


HOUSING_SQL = """housing AS (
  SELECT o_orderkey, n_lines, total_qty,
         total_qty / n_lines::DOUBLE AS qty_per_line,
         total_disc / n_lines::DOUBLE AS disc_per_line,
         total_tax / n_lines::DOUBLE AS tax_per_line,
         o_totalprice / 1000.0 AS price_k, total_value / 1000.0 AS value_k
  FROM orders JOIN (
    SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS total_qty, sum(l_discount) AS total_disc,
           sum(l_tax) AS total_tax, sum(l_extendedprice) AS total_value
    FROM lineitem GROUP BY l_orderkey) a ON o_orderkey = a.l_orderkey)"""

FRAUD_DIMS = 64


def fraud_like(spark: SparkSession, sf_dir: str, dims: int = FRAUD_DIMS) -> DataFrame:
    """Embedding coordinates as features; class 0 is the rare positive, planted at 10x scale."""
    e = table(spark, sf_dir, "embeddings")
    pos = F.col("label") == 0
    feats = [
        (F.when(pos, F.lit(10.0)).otherwise(F.lit(1.0)) * F.col("embedding")[i].cast("double")).alias(f"v{i + 1}")
        for i in range(dims)
    ]
    return e.select("vec_id", *feats, pos.cast("int").alias("Class"))


def fraud_sql(dims: int = FRAUD_DIMS) -> str:
    feats = ", ".join(
        f"(CASE WHEN label = 0 THEN 10.0 ELSE 1.0 END) * CAST(embedding[{i + 1}] AS DOUBLE) AS v{i + 1}" for i in range(dims)
    )
    return f"fraud AS (SELECT vec_id, {feats}, CAST(label = 0 AS INTEGER) AS Class FROM embeddings)"


def score_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        *LOAN_KEY,
        F.col("l_extendedprice").alias("score"),
        F.col("l_quantity").alias("score_ties"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


SCORE_SQL = """scored AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS score, l_quantity AS score_ties,
         CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem)"""


def text_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
