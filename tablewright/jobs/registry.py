"""Registered queries: one Spark query per operator and its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs on the whole driver
tables; ``ORACLE[name]`` is the same computation in DuckDB SQL over the
pre-registered views.  Floating results that two engines may compute with
different summation orders are rounded on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import text as tf
from tablewright.functions.hashing import sql_hash32, sql_unit_hash
from tablewright.functions.stemming import stem_sql
from tablewright.jobs import fixtures as fx
from tablewright.operators import clean, evaluate, features, profile, splits, text
from tablewright.session import ensure_checkpoint_dir
from tablewright.sources import io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def _r(c: str, d: int = 6):
    return F.round(F.col(c), d).alias(c)


LOAN_COLS = fx.LOAN_KEY + fx.LOAN_NUMERIC + fx.LOAN_CATEGORICAL + ["status"]
LINEITEM_COLS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
KEYS = ", ".join(fx.LOAN_KEY)

# ---------------------------------------------------------------- sources


@register("read_delimited", f"SELECT {', '.join(LINEITEM_COLS)} FROM lineitem")
def q_read_delimited(spark, sf):
    li = fx.table(spark, sf, "lineitem").select(*LINEITEM_COLS)
    path = f"{ensure_checkpoint_dir(spark)}/tw-csv-{uuid.uuid4().hex}"
    io.write_delimited(li, path, sep=";")
    return io.read_delimited(spark, path, schema=li.schema, sep=";")


@register("read_delimited_infer", f"SELECT {', '.join(LINEITEM_COLS)} FROM lineitem")
def q_read_delimited_infer(spark, sf):
    li = fx.table(spark, sf, "lineitem").select(*LINEITEM_COLS)
    path = f"{ensure_checkpoint_dir(spark)}/tw-csv-{uuid.uuid4().hex}"
    io.write_delimited(li, path, sep=";")
    return io.read_delimited(spark, path, sep=";", infer=True, pin=li.schema)


LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# two kinds of broken lines: a value of another type, and a field too few
BROKEN_SQL = """lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber
    WHEN 6 THEN concat_ws(';', l_orderkey, l_linenumber, 'x' || l_partkey, l_suppkey)
    WHEN 7 THEN concat_ws(';', l_orderkey, l_linenumber, l_partkey)
    ELSE concat_ws(';', l_orderkey, l_linenumber, l_partkey, l_suppkey) END AS line FROM lineitem)"""


def _broken_lines(spark, sf):
    li = fx.table(spark, sf, "lineitem").select(*[F.col(c).cast("long").alias(c) for c in LINE_COLS])
    key, number, part, supp = (F.col(c) for c in LINE_COLS)
    line = F.when(number == 6, F.concat_ws(";", key, number, F.concat(F.lit("x"), part), supp)).when(
        number == 7, F.concat_ws(";", key, number, part)).otherwise(F.concat_ws(";", key, number, part, supp))
    path = f"{ensure_checkpoint_dir(spark)}/tw-broken-{uuid.uuid4().hex}"
    li.select(line.alias("value")).write.text(path)
    return io.read_delimited(spark, path, schema=li.schema, header=False, corrupt="bad_line")


@register("read_delimited_corrupt", "WITH " + BROKEN_SQL + """ SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber <> 6 THEN l_partkey END AS l_partkey, CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS l_suppkey,
  CASE WHEN l_linenumber >= 6 THEN line END AS bad_line FROM lines""")
def q_read_corrupt(spark, sf):
    """Lines that don't fit the schema keep their text beside what could be read."""
    return _broken_lines(spark, sf)


@register("reject_report", """SELECT count(*) AS n_rows, count_if(l_linenumber < 6) AS n_good, count_if(l_linenumber >= 6) AS n_rejected,
  count_if(l_linenumber < 6) AS n_kept, sum(CASE WHEN l_linenumber < 6 THEN l_partkey END)::BIGINT AS kept_parts FROM lineitem""")
def q_reject_report(spark, sf):
    """The report and the good side of the quarantine."""
    df = _broken_lines(spark, sf)
    good, _ = io.quarantine(df, "bad_line")
    kept = good.agg(F.count(F.lit(1)).alias("n_kept"), F.sum("l_partkey").alias("kept_parts"))
    return io.reject_report(df, "bad_line").join(F.broadcast(kept))  # one row each


@register("read_text_files", r"""SELECT source, string_agg(regexp_replace(text, '[\r\n]', ' ', 'g') || chr(10), '' ORDER BY doc_id) AS text
  FROM documents WHERE text IS NOT NULL GROUP BY source""")
def q_read_text_files(spark, sf):
    """S3: one row a file; the files are the documents of each source, a line each."""
    docs = fx.table(spark, sf, "documents").where(F.col("text").isNotNull())
    lines = docs.select("source", "doc_id", F.regexp_replace("text", r"[\r\n]", " ").alias("value"))
    path = f"{ensure_checkpoint_dir(spark)}/tw-texts-{uuid.uuid4().hex}"
    lines.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").text(path)
    files = io.read_text_files(spark, f"{path}/*")
    return files.select(F.regexp_extract("path", "source=([^/]*)/", 1).alias("source"), "text")


@register("read_corpus", "SELECT doc_id, text, lang AS label FROM documents")
def q_read_corpus(spark, sf):
    return io.read_corpus(spark, f"{sf}/documents.parquet", label_col="lang")


@register("preview", f"SELECT * FROM lineitem ORDER BY {KEYS} LIMIT 10")
def q_preview(spark, sf):
    return io.preview(fx.table(spark, sf, "lineitem"), 10, fx.LOAN_KEY)


@register("shape", "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem")
def q_shape(spark, sf):
    return io.shape(fx.table(spark, sf, "lineitem"))


# ---------------------------------------------------------------- projections / missing data

W_LOAN = "WITH " + fx.LOAN_SQL


@register("select_columns", W_LOAN + f" SELECT {KEYS}, l_quantity, status FROM loan")
def q_select(spark, sf):
    return clean.select_columns(fx.loan_like(spark, sf), [*fx.LOAN_KEY, "l_quantity", "status"])


@register("drop_columns", W_LOAN + f" SELECT {KEYS}, l_quantity, l_extendedprice, l_tax, l_discount, l_returnflag, l_linestatus, status FROM loan")
def q_drop(spark, sf):
    return clean.drop_columns(fx.loan_like(spark, sf), ["unit_price"])


@register("scale_by", W_LOAN + f" SELECT {KEYS}, l_tax * 0.01 AS l_tax FROM loan")
def q_scale(spark, sf):
    return clean.scale_by(fx.loan_like(spark, sf), "l_tax", 0.01).select(*fx.LOAN_KEY, "l_tax")


@register("ratio", f"SELECT {KEYS}, CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS tax_per_discount FROM lineitem")
def q_ratio(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return clean.ratio(li, "l_tax", "l_discount", "tax_per_discount").select(*fx.LOAN_KEY, "tax_per_discount")


@register("null_counts", W_LOAN + " SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in LOAN_COLS) + " FROM loan")
def q_null_counts(spark, sf):
    return clean.null_counts(fx.loan_like(spark, sf), LOAN_COLS)


NAN_SQL = """nanny AS (
  SELECT l_orderkey, l_quantity, CASE WHEN l_tax = 0.0 THEN 'NaN'::DOUBLE ELSE l_tax END AS l_tax,
         nullif(l_discount, 0.0) AS l_discount, l_returnflag FROM lineitem)"""


def _nanny(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_quantity",
        F.when(F.col("l_tax") == 0.0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_discount") != 0.0, F.col("l_discount")).alias("l_discount"),
        "l_returnflag",
    )


@register("nan_counts", "WITH " + NAN_SQL + """ SELECT 0::BIGINT AS l_orderkey, count_if(isnan(l_quantity)) AS l_quantity,
  count_if(isnan(l_tax)) AS l_tax, count_if(isnan(l_discount)) AS l_discount, 0::BIGINT AS l_returnflag FROM nanny""")
def q_nan_counts(spark, sf):
    return clean.nan_counts(_nanny(spark, sf))


@register("columns_with_missing", "WITH " + NAN_SQL + """ SELECT (
  max(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) + max(CASE WHEN l_quantity IS NULL OR isnan(l_quantity) THEN 1 ELSE 0 END)
  + max(CASE WHEN l_tax IS NULL OR isnan(l_tax) THEN 1 ELSE 0 END) + max(CASE WHEN l_discount IS NULL OR isnan(l_discount) THEN 1 ELSE 0 END)
  + max(CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END))::BIGINT AS n_columns_with_missing FROM nanny""")
def q_cols_missing(spark, sf):
    return clean.columns_with_missing(_nanny(spark, sf))


@register("missing_fraction", W_LOAN + " SELECT " + ", ".join(
    f"1 - count({c})::DOUBLE / count(*)::DOUBLE AS {c}_missing" for c in LOAN_COLS) + " FROM loan")
def q_missing_fraction(spark, sf):
    return clean.missing_fraction(fx.loan_like(spark, sf), LOAN_COLS)


@register("drop_missing", "WITH " + NAN_SQL + """ SELECT * FROM nanny WHERE l_orderkey IS NOT NULL
  AND l_quantity IS NOT NULL AND NOT isnan(l_quantity) AND l_tax IS NOT NULL AND NOT isnan(l_tax)
  AND l_discount IS NOT NULL AND NOT isnan(l_discount) AND l_returnflag IS NOT NULL""")
def q_drop_missing(spark, sf):
    return clean.drop_missing(_nanny(spark, sf))


@register("drop_missing_min_non_null", "WITH " + NAN_SQL + """ SELECT * FROM nanny WHERE
  (CASE WHEN l_orderkey IS NULL THEN 0 ELSE 1 END) + (CASE WHEN l_quantity IS NULL OR isnan(l_quantity) THEN 0 ELSE 1 END)
  + (CASE WHEN l_tax IS NULL OR isnan(l_tax) THEN 0 ELSE 1 END) + (CASE WHEN l_discount IS NULL OR isnan(l_discount) THEN 0 ELSE 1 END)
  + (CASE WHEN l_returnflag IS NULL THEN 0 ELSE 1 END) >= 4""")
def q_drop_thresh(spark, sf):
    return clean.drop_missing(_nanny(spark, sf), min_non_null=4)


@register("require", W_LOAN + " SELECT * FROM loan WHERE l_discount IS NOT NULL AND NOT isnan(l_discount)")
def q_require(spark, sf):
    return clean.require(fx.loan_like(spark, sf), ["l_discount"])


@register("fill_missing", W_LOAN + f" SELECT {KEYS}, coalesce(l_discount, 0.0) AS l_discount, unit_price FROM loan")
def q_fill(spark, sf):
    df = fx.loan_like(spark, sf)
    return clean.fill_missing(df, {"l_discount": 0}).select(*fx.LOAN_KEY, "l_discount", "unit_price")


W_HOUSE = "WITH " + fx.HOUSING_SQL


@register("trim_outliers", W_HOUSE + " SELECT * FROM housing WHERE qty_per_line >= 10 AND qty_per_line < 40 AND price_k < 400")
def q_trim(spark, sf):
    return clean.trim_outliers(fx.housing_like(spark, sf), {"qty_per_line": (10, 40), "price_k": (None, 400)})


@register("trim_report", W_HOUSE + """ SELECT count(*) AS n_rows,
  count_if(NOT coalesce(qty_per_line >= 10 AND qty_per_line < 40, false)) AS qty_per_line_dropped,
  count_if(NOT coalesce(price_k < 400, false)) AS price_k_dropped,
  count_if(coalesce(qty_per_line >= 10 AND qty_per_line < 40, false) AND coalesce(price_k < 400, false)) AS n_kept FROM housing""")
def q_trim_report(spark, sf):
    return clean.trim_report(fx.housing_like(spark, sf), {"qty_per_line": (10, 40), "price_k": (None, 400)})


# Thirteen of the 25 nation levels are collapsed (stand-in for the rare states).
SMALL_NATIONS = [f"N{i}" for i in range(12, 25)]
W_LEVELS = "WITH " + fx.LEVELS_SQL


@register("collapse_levels", W_LEVELS + " SELECT c_custkey, CASE WHEN nation IN ("
          + ", ".join(f"'{n}'" for n in SMALL_NATIONS) + ") THEN 'FEW' ELSE nation END AS nation FROM levels")
def q_collapse_levels(spark, sf):
    df = fx.levels_like(spark, sf)
    return clean.collapse_levels(df, "nation", SMALL_NATIONS, "FEW").select("c_custkey", "nation")


@register("collapse_rare", W_LEVELS + """, cnt AS (SELECT nation AS lvl, count(*) AS n FROM levels GROUP BY nation)
  SELECT c_custkey, CASE WHEN n < 60 THEN 'OTHER' ELSE nation END AS nation FROM levels JOIN cnt ON nation = lvl""")
def q_collapse_rare(spark, sf):
    df = fx.levels_like(spark, sf)
    return clean.collapse_rare(df, "nation", 60, "OTHER").select("c_custkey", "nation")


W_FRAUD = "WITH " + fx.fraud_sql()


@register("recode", W_FRAUD + " SELECT vec_id, Class, CASE WHEN Class = 1 THEN -1 WHEN Class = 0 THEN 1 ELSE Class END AS y FROM fraud")
def q_recode(spark, sf):
    return clean.recode(fx.fraud_like(spark, sf), "Class", {1: -1, 0: 1}, out="y").select("vec_id", "Class", "y")


@register("clip", W_HOUSE + " SELECT o_orderkey, least(greatest(price_k, 5.0), 300.0) AS price_k FROM housing")
def q_clip(spark, sf):
    return clean.clip(fx.housing_like(spark, sf), "price_k", 5.0, 300.0).select("o_orderkey", "price_k")


# ---------------------------------------------------------------- profiling

HOUSE_NUM = ["n_lines", "total_qty", "qty_per_line", "disc_per_line", "tax_per_line", "price_k"]


def _describe_sql(src: str, cols: list[str], extra: str = "") -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}::DOUBLE), 6) AS mean, "
            f"round(stddev_samp({c}::DOUBLE), 6) AS stddev, round(min({c}::DOUBLE), 6) AS min, "
            f"round(max({c}::DOUBLE), 6) AS max{extra.format(c=c)} FROM {src}"
        )
    return " UNION ALL ".join(parts)


@register("describe", W_LOAN + " " + _describe_sql("loan", fx.LOAN_NUMERIC))
def q_describe(spark, sf):
    d = profile.describe(fx.loan_like(spark, sf), fx.LOAN_NUMERIC)
    return d.select("column", "count", *[_r(c) for c in ["mean", "stddev", "min", "max"]])


@register("summary", W_HOUSE + " " + _describe_sql(
    "housing", HOUSE_NUM,
    ", round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50, "
    "round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75"))
def q_summary(spark, sf):
    d = profile.summary(fx.housing_like(spark, sf), HOUSE_NUM)
    return d.select("column", "count", *[_r(c) for c in ["mean", "stddev", "min", "max", "p25", "p50", "p75"]])


@register("means", W_HOUSE + " SELECT " + ", ".join(f"round(avg({c}::DOUBLE), 6) AS {c}" for c in HOUSE_NUM) + " FROM housing")
def q_means(spark, sf):
    return profile.means(fx.housing_like(spark, sf), HOUSE_NUM).select(*[_r(c) for c in HOUSE_NUM])


@register("value_counts", W_LEVELS + " SELECT nation, count(*) AS count FROM levels GROUP BY nation")
def q_value_counts(spark, sf):
    return profile.value_counts(fx.levels_like(spark, sf), "nation")


@register("cardinality", "SELECT " + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in LINEITEM_COLS) + " FROM lineitem")
def q_cardinality(spark, sf):
    return profile.cardinality(fx.table(spark, sf, "lineitem"), LINEITEM_COLS)


@register("cardinality_mixed", "WITH " + NAN_SQL + """ SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_tax) AS l_tax,
  count(DISTINCT l_discount) AS l_discount, count(DISTINCT l_returnflag) AS l_returnflag FROM nanny""")
def q_cardinality_mixed(spark, sf):
    """A5 over a derived table with NaN and NULL, in one pass."""
    return profile.cardinality(_nanny(spark, sf), ["l_orderkey", "l_tax", "l_discount", "l_returnflag"])


SKETCH_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
SKETCH_RANK = 0.02


def _sketches(spark, sf):
    """Sketches by return flag and line status of two loads, merged by return flag."""
    li = fx.table(spark, sf, "lineitem")
    loads = [li.where("l_linenumber <= 2"), li.where("l_linenumber > 2")]
    by = ["l_returnflag", "l_linestatus"]
    return li, profile.merge_sketches(*[profile.sketch(d, SKETCH_COLS, by) for d in loads], by=["l_returnflag"])


def _rank_checked(li, found, quantiles: dict[str, float]):
    """``near``: whether the exact rank of every quantile is within SKETCH_RANK of its share."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in SKETCH_COLS])
    rows = li.select(F.col("l_returnflag").alias("_g"), F.explode(pairs).alias("p")).select("_g", F.col("p.column").alias("_c"), F.col("p.x").alias("_x"))
    # a row for each flag and column
    joined = rows.join(F.broadcast(found), (F.col("_g") == F.col("l_returnflag")) & (F.col("_c") == F.col("column")))
    counts = []
    for q in quantiles:
        counts += [F.count_if(F.col("_x") < F.col(q)).alias(f"{q}_lo"), F.count_if(F.col("_x") <= F.col(q)).alias(f"{q}_hi")]
    ranks = joined.groupBy("l_returnflag", "column").agg(F.count(F.lit(1)).alias("_n"), *counts)
    near = F.lit(True)
    for q, p in quantiles.items():
        near = near & (F.col(f"{q}_lo") <= (p + SKETCH_RANK) * F.col("_n")) & (F.col(f"{q}_hi") >= (p - SKETCH_RANK) * F.col("_n"))
    return found.join(ranks.select("l_returnflag", "column", near.alias("near")), ["l_returnflag", "column"])


@register("summary_sketch", " UNION ALL ".join(f"""SELECT l_returnflag, '{c}' AS "column", count({c}) AS count, round(avg({c}::DOUBLE), 6) AS mean,
  min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, true AS near FROM lineitem GROUP BY l_returnflag""" for c in SKETCH_COLS))
def q_summary_sketch(spark, sf):
    """A2 from merged sketches: exact counts, means and ends; quantiles within 2 % of their rank."""
    li, merged = _sketches(spark, sf)
    found = _rank_checked(li, profile.sketch_summary(merged), {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return found.select("l_returnflag", "column", "count", _r("mean"), "min", "max", "near")


@register("box_sketch", " UNION ALL ".join(f"""SELECT l_returnflag, '{c}' AS "column", count({c}) AS count, min({c})::DOUBLE AS min,
  max({c})::DOUBLE AS max, true AS near, true AS share_near FROM lineitem GROUP BY l_returnflag""" for c in SKETCH_COLS))
def q_box_sketch(spark, sf):
    """A11 from merged sketches: quartiles and the share of outliers within 2 % of their rank."""
    li, merged = _sketches(spark, sf)
    found = _rank_checked(li, profile.sketch_box(merged), {"q1": 0.25, "median": 0.5, "q3": 0.75})
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in SKETCH_COLS])
    rows = li.select(F.col("l_returnflag").alias("_g"), F.explode(pairs).alias("p")).select("_g", F.col("p.column").alias("_c"), F.col("p.x").alias("_x"))
    fences = F.broadcast(found.select("l_returnflag", "column", "lower_fence", "upper_fence"))
    out = rows.join(fences, (F.col("_g") == F.col("l_returnflag")) & (F.col("_c") == F.col("column")))
    out = out.groupBy("l_returnflag", "column").agg(
        F.avg(((F.col("_x") < F.col("lower_fence")) | (F.col("_x") > F.col("upper_fence"))).cast("double")).alias("_share"))
    near = F.abs(F.col("_share") - F.col("outlier_share")) <= 2 * SKETCH_RANK
    return found.join(out, ["l_returnflag", "column"]).select("l_returnflag", "column", "count", "min", "max", "near", near.alias("share_near"))


MIXED_SQL = """mixed AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0.0 THEN 'NaN'::DOUBLE ELSE l_tax END AS x,
  nullif(l_discount, 0.0) AS y, 7.5::DOUBLE AS k, nullif(l_returnflag, 'A') AS s FROM lineitem)"""
CLEAN_MIXED = ", clean AS (SELECT CASE WHEN isnan(x) THEN NULL ELSE x END AS x, y, k, s FROM mixed)"


def _mixed(spark, sf):
    """NaN, NULL, a constant and a string column."""
    li = fx.table(spark, sf, "lineitem")
    return li.select(
        F.when(F.col("l_tax") == 0.0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("x"),
        F.when(F.col("l_discount") != 0.0, F.col("l_discount")).alias("y"), F.lit(7.5).alias("k"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("s"))


@register("describe_mixed", "WITH " + MIXED_SQL + CLEAN_MIXED + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, min({c}) AS min,
  max({c}) AS max, NULL::VARCHAR AS text_min, NULL::VARCHAR AS text_max FROM clean""" for c in "xyk") + """
  UNION ALL SELECT 's', count(s), NULL, NULL, NULL, NULL, min(s), max(s) FROM clean""")
def q_describe_mixed(spark, sf):
    d = profile.describe(_mixed(spark, sf))
    return d.select("column", "count", _r("mean"), _r("stddev"), "min", "max", "text_min", "text_max")


@register("summary_nan", "WITH " + MIXED_SQL + CLEAN_MIXED + " " + _describe_sql(
    "clean", ["x", "y", "k"],
    ", round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75"))
def q_summary_nan(spark, sf):
    d = profile.summary(_mixed(spark, sf), ["x", "y", "k"])
    return d.select("column", "count", *[_r(c) for c in ["mean", "stddev", "min", "max", "p25", "p50", "p75"]])


@register("histogram_nan", "WITH " + MIXED_SQL + CLEAN_MIXED + """, s AS (SELECT min(x) AS lo, max(x) AS hi FROM clean),
  c AS (SELECT least(floor((x - lo) / (hi - lo) * 10), 9)::INTEGER AS bin, count(*) AS count FROM clean, s WHERE x IS NOT NULL GROUP BY bin)
  SELECT g.bin::INTEGER AS bin, coalesce(c.count, 0)::BIGINT AS count FROM range(10) g(bin) LEFT JOIN c ON c.bin = g.bin""")
def q_histogram_nan(spark, sf):
    return profile.histogram(_mixed(spark, sf), "x", 10).select("bin", "count")


@register("correlate_constant", "WITH " + MIXED_SQL + CLEAN_MIXED + """
  SELECT 'y' AS feature, round(corr(x, y), 6) AS r FROM clean UNION ALL SELECT 'k', NULL""")
def q_correlate_constant(spark, sf):
    return profile.correlate_with(_mixed(spark, sf), "x", ["y", "k"]).select("feature", _r("r"))


@register("schema_table", "SELECT * FROM (VALUES " + ", ".join(
    f"({i + 1}, '{c}', '{t}')" for i, (c, t) in enumerate(
        [("l_orderkey", "bigint"), ("l_quantity", "double"), ("l_tax", "double"), ("l_discount", "double"), ("l_returnflag", "string")]))
    + """) v(ordinal, name, type) JOIN (SELECT unnest(['l_orderkey', 'l_quantity', 'l_tax', 'l_discount', 'l_returnflag']) AS name,
  unnest([count_if(l_orderkey IS NULL), count_if(l_quantity IS NULL), 0, count_if(l_discount = 0.0), count_if(l_returnflag IS NULL)]) AS n_null
  FROM lineitem) USING (name)""")
def q_schema_table(spark, sf):
    """S6 with the number of missing values of each column."""
    df = _nanny(spark, sf)
    counts = clean.null_counts(df, df.columns)
    long = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n_null")) for c in df.columns])))
    return io.schema_table(df).select("ordinal", "name", "type").join(long, "name")


@register("numeric_columns", "SELECT " + ", ".join(
    f"round(avg({c}::DOUBLE), 6) AS {c}" for c in ("c_custkey", "c_nationkey", "c_acctbal")) + " FROM customer")
def q_numeric_columns(spark, sf):
    """The means of exactly the numeric columns."""
    df = fx.table(spark, sf, "customer")
    return profile.means(df, clean.numeric_columns(df)).select(*[_r(c) for c in clean.numeric_columns(df)])


WIDE_FEATS = [f"v{i + 1}" for i in range(fx.FRAUD_DIMS)]
W_WIDE = "WITH " + fx.fraud_sql() + ", wide AS (SELECT * REPLACE (CASE WHEN vec_id % 3 = 0 THEN NULL ELSE v64 END AS v64) FROM fraud)"


@register("correlation_matrix_wide", W_WIDE + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT 'v{i}' AS col_a, unnest([{', '.join(repr(c) for c in WIDE_FEATS)}]) AS col_b, unnest(["
    + ", ".join(f"round(corr(v{i}, {c}), 3)" if c != f"v{i}" else "1.0" for c in WIDE_FEATS) + "]) AS r FROM wide" for i in range(1, fx.FRAUD_DIMS + 1)) + ")")
def q_corr_matrix_wide(spark, sf):
    """A8 on 64 columns, one of them with missing values: the same formula as for few."""
    df = fx.fraud_like(spark, sf).withColumn("v64", F.when(F.col("vec_id") % 3 != 0, F.col("v64")))
    return profile.correlation_matrix(df, WIDE_FEATS)


FRAUD_FEATS = [f"v{i + 1}" for i in range(fx.FRAUD_DIMS)]


@register("correlate_with", W_FRAUD + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, Class::DOUBLE), 6) AS r FROM fraud" for c in FRAUD_FEATS))
def q_corr_with(spark, sf):
    return profile.correlate_with(fx.fraud_like(spark, sf), "Class", FRAUD_FEATS).select("feature", _r("r"))


@register("top_correlated", W_FRAUD + ", r AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, Class::DOUBLE) AS r FROM fraud" for c in FRAUD_FEATS)
    + ") SELECT feature, round(r, 6) AS r, round(abs(r), 6) AS abs_r, row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS rank FROM r")
def q_top_corr(spark, sf):
    t = profile.top_correlated(fx.fraud_like(spark, sf), "Class", FRAUD_FEATS)
    return t.select("feature", _r("r"), _r("abs_r"), F.col("rank").cast("long").alias("rank"))


def _pairs_sql(cols, src, with_diag=True, where=""):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM {src}")
            parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM {src}")
        if with_diag:
            parts.append(f"SELECT '{a}' AS col_a, '{a}' AS col_b, 1.0 AS r")
    return " UNION ALL ".join(parts)


@register("correlation_matrix", W_HOUSE + ", m AS (" + _pairs_sql(HOUSE_NUM, "housing") + ") SELECT col_a, col_b, round(r, 3) AS r FROM m")
def q_corr_matrix(spark, sf):
    return profile.correlation_matrix(fx.housing_like(spark, sf), HOUSE_NUM)


def _upper_sql(cols, src):
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM {src}")
    return " UNION ALL ".join(parts)


@register("redundant_features", W_HOUSE + ", m AS (" + _upper_sql(HOUSE_NUM, "housing") + ") SELECT col_a, col_b, round(r, 6) AS r FROM m WHERE abs(r) > 0.82")
def q_redundant(spark, sf):
    return profile.redundant_features(fx.housing_like(spark, sf), 0.82, HOUSE_NUM).select("col_a", "col_b", _r("r"))


@register("histogram", W_HOUSE + """, s AS (SELECT min(price_k) AS lo, max(price_k) AS hi FROM housing),
  b AS (SELECT CAST(least(floor((price_k - lo) / (hi - lo) * 31), 30) AS INTEGER) AS bin FROM housing, s),
  c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin)
  SELECT g.bin::INTEGER AS bin, round(lo + g.bin * (hi - lo) / 31, 6) AS lo, round(lo + (g.bin + 1) * (hi - lo) / 31, 6) AS hi,
         coalesce(c.count, 0)::BIGINT AS count
  FROM range(31) g(bin) CROSS JOIN s LEFT JOIN c ON c.bin = g.bin""")
def q_histogram(spark, sf):
    return profile.histogram(fx.housing_like(spark, sf), "price_k", 31).select("bin", _r("lo"), _r("hi"), "count")


def _box_sql(cols, src):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence,
  q3 + 1.5 * (q3 - q1) AS upper_fence,
  (SELECT min({c}) FROM {src} WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_lo,
  (SELECT max({c}) FROM {src} WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_hi,
  (SELECT count(*) FROM {src} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.5) AS median,
               quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {src})""")
    return " UNION ALL ".join(parts)


BOX_FIELDS = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_lo", "whisker_hi"]


@register("box_stats", W_HOUSE + ", bx AS (" + _box_sql(HOUSE_NUM, "housing") + ") SELECT \"column\", "
          + ", ".join(f"round({f}::DOUBLE, 6) AS {f}" for f in BOX_FIELDS) + ", n_outliers FROM bx")
def q_box(spark, sf):
    b = profile.box_stats(fx.housing_like(spark, sf), HOUSE_NUM)
    return b.select("column", *[_r(f) for f in BOX_FIELDS], "n_outliers")


@register("class_balance", W_FRAUD + " SELECT Class, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM fraud GROUP BY Class")
def q_class_balance(spark, sf):
    return profile.class_balance(fx.fraud_like(spark, sf), "Class").select("Class", "count", _r("share"))


@register("top_k", W_HOUSE + " SELECT o_orderkey, price_k FROM housing ORDER BY price_k DESC, o_orderkey LIMIT 10")
def q_top_k(spark, sf):
    return profile.top_k(fx.housing_like(spark, sf), [F.col("price_k").desc(), "o_orderkey"], 10, ["o_orderkey", "price_k"])


# ---------------------------------------------------------------- splits

@register("split", W_LOAN + f""" SELECT {KEYS},
  CASE WHEN {sql_unit_hash(1234, fx.LOAN_KEY)} >= 0.8 THEN 1 ELSE 0 END AS split FROM loan""")
def q_split(spark, sf):
    df = fx.loan_like(spark, sf).select(*fx.LOAN_KEY)
    return splits.assign_split(df, [0.8, 0.2], 1234, fx.LOAN_KEY)


@register("sample_n", W_HOUSE + f" SELECT * FROM housing ORDER BY {sql_hash32(7, ['o_orderkey'])}, o_orderkey LIMIT 500")
def q_sample_n(spark, sf):
    return splits.sample_n(fx.housing_like(spark, sf), 500, 7, ["o_orderkey"])


@register("stratified_folds", W_FRAUD + f""" SELECT vec_id, Class,
  CAST((row_number() OVER (PARTITION BY Class ORDER BY {sql_hash32(50, ['vec_id'])}, vec_id) - 1) % 3 AS INTEGER) AS fold FROM fraud""")
def q_strat(spark, sf):
    df = fx.fraud_like(spark, sf).select("vec_id", "Class")
    return splits.stratified_folds(df, "Class", 3, 50, ["vec_id"])


@register("shuffle_splits", W_HOUSE + f""" SELECT s.split_id::INTEGER AS split_id, o_orderkey,
  {sql_unit_hash(0, ['s.split_id', 'o_orderkey'])} < 0.25 AS is_test FROM housing CROSS JOIN range(5) s(split_id)""")
def q_shuffle_splits(spark, sf):
    df = fx.housing_like(spark, sf).select("o_orderkey")
    return splits.shuffle_splits(df, 5, 0.25, 0, ["o_orderkey"])


@register("folds", W_HOUSE + f" SELECT o_orderkey, ({sql_hash32(3, ['o_orderkey'])} % 5)::INTEGER AS fold FROM housing")
def q_folds(spark, sf):
    return splits.folds(fx.housing_like(spark, sf).select("o_orderkey"), 5, 3, ["o_orderkey"])


@register("head_tail_split", W_HOUSE + f""" SELECT o_orderkey,
  row_number() OVER (ORDER BY {sql_hash32(11, ['o_orderkey'])}, o_orderkey) <= 4000 AS is_head FROM housing""")
def q_head_tail(spark, sf):
    return splits.head_tail_split_seeded(fx.housing_like(spark, sf).select("o_orderkey"), 4000, 11, ["o_orderkey"])


@register("head_tail_split_ordered", W_HOUSE + """ SELECT o_orderkey,
  row_number() OVER (ORDER BY price_k DESC, o_orderkey) <= 4000 AS is_head FROM housing""")
def q_head_tail_ordered(spark, sf):
    df = fx.housing_like(spark, sf).select("o_orderkey", "price_k")
    return splits.head_tail_split(df, 4000, [F.col("price_k").desc(), "o_orderkey"]).drop("price_k")


# ---------------------------------------------------------------- features

LEVEL_INDEX_SQL = """lvl AS (SELECT l_returnflag AS lv, (row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1)::DOUBLE AS idx
  FROM loan GROUP BY l_returnflag)"""


@register("index_category", W_LOAN + ", " + LEVEL_INDEX_SQL + f" SELECT {KEYS}, l_returnflag, idx AS l_returnflag_index FROM loan JOIN lvl ON l_returnflag = lv")
def q_index_category(spark, sf):
    df = fx.loan_like(spark, sf)
    m = features.index_category("l_returnflag").fit(df)
    return m.transform(df).select(*fx.LOAN_KEY, "l_returnflag", "l_returnflag_index")


@register("index_label", W_LOAN + """, lab AS (SELECT status AS lv, (row_number() OVER (ORDER BY count(*) DESC, status) - 1)::DOUBLE AS idx
  FROM loan GROUP BY status)""" + f" SELECT {KEYS}, idx AS label FROM loan JOIN lab ON status = lv")
def q_index_label(spark, sf):
    df = fx.loan_like(spark, sf)
    return features.index_label("status", "label").fit(df).transform(df).select(*fx.LOAN_KEY, "label")


@register("one_hot", W_LOAN + ", " + LEVEL_INDEX_SQL + f""" SELECT {KEYS}, idx::INTEGER AS hot_slot,
  (SELECT count(DISTINCT l_returnflag) FROM loan)::INTEGER AS n_slots FROM loan JOIN lvl ON l_returnflag = lv""")
def q_one_hot(spark, sf):
    df = fx.loan_like(spark, sf)
    idx = features.index_category("l_returnflag", handle_invalid="error").fit(df).transform(df)
    enc = features.one_hot(["l_returnflag_index"]).fit(idx).transform(idx)
    arr = vector_to_array(F.col("l_returnflag_onehot"))
    return enc.select(
        *fx.LOAN_KEY, (F.array_position(arr, 1.0) - 1).cast("int").alias("hot_slot"), F.size(arr).alias("n_slots")
    )


@register("assemble", W_LOAN + ", " + LEVEL_INDEX_SQL + f""" SELECT {KEYS}, l_quantity AS f0, l_tax AS f1,
  CASE WHEN idx = 0 THEN 1.0 ELSE 0.0 END AS f2, CASE WHEN idx = 1 THEN 1.0 ELSE 0.0 END AS f3,
  CASE WHEN idx = 2 THEN 1.0 ELSE 0.0 END AS f4 FROM loan JOIN lvl ON l_returnflag = lv""")
def q_assemble(spark, sf):
    df = fx.loan_like(spark, sf)
    idx = features.index_category("l_returnflag", handle_invalid="error").fit(df).transform(df)
    enc = features.one_hot(["l_returnflag_index"]).fit(idx).transform(idx)
    vec = features.assemble(["l_quantity", "l_tax", "l_returnflag_onehot"]).transform(enc)
    arr = vector_to_array(F.col("features"))
    return vec.select(*fx.LOAN_KEY, *[arr[i].alias(f"f{i}") for i in range(5)])


def _hot_sql(col: str, start: int, levels: int) -> str:
    return ", ".join(f"CASE WHEN {col} = {i} THEN 1.0 ELSE 0.0 END AS f{start + i}" for i in range(levels))


def _rank_sql(col: str, name: str) -> str:
    return f"""{name} AS (SELECT {col} AS {name}_v, row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS {name}_i
  FROM loan GROUP BY {col})"""


@register("feature_pipeline", W_LOAN + ", " + ", ".join(
    _rank_sql(c, n) for c, n in (("l_returnflag", "rf"), ("l_linestatus", "ls"), ("status", "st"))) + f"""
  SELECT {KEYS}, l_quantity AS f0, l_tax AS f1, {_hot_sql("rf_i", 2, 3)}, {_hot_sql("ls_i", 5, 2)}, st_i::DOUBLE AS label, 7 AS n_slots
  FROM loan JOIN rf ON l_returnflag = rf_v JOIN ls ON l_linestatus = ls_v JOIN st ON status = st_v""")
def q_feature_pipeline(spark, sf):
    """Every slot of the assembled vector, and the indexed label."""
    df = fx.loan_like(spark, sf)
    spec = features.FeatureSpec(label="status", numeric=["l_quantity", "l_tax"], categorical=["l_returnflag", "l_linestatus"])
    out = features.feature_pipeline(spec).fit(df).transform(df)
    arr = vector_to_array(F.col("features"))
    return out.select(*fx.LOAN_KEY, *[arr[i].alias(f"f{i}") for i in range(7)], "label", F.size(arr).alias("n_slots"))


STD_COLS = ["qty_per_line", "disc_per_line", "price_k"]


@register("standardize", W_HOUSE + " SELECT o_orderkey, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM housing)) / (SELECT stddev_samp({c}) FROM housing), 6) AS {c}" for c in STD_COLS) + " FROM housing")
def q_standardize(spark, sf):
    df = fx.housing_like(spark, sf)
    stats = features.fit_standardize_columns(df, STD_COLS, ddof=1)
    return features.apply_standardize_columns(df, stats).select("o_orderkey", *[_r(c) for c in STD_COLS])


@register("standardize_vector", W_HOUSE + " SELECT o_orderkey, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM housing)) / (SELECT stddev_samp({c}) FROM housing), 6) AS s{i}" for i, c in enumerate(STD_COLS)) + " FROM housing")
def q_standardize_vec(spark, sf):
    df = features.assemble(STD_COLS, "raw").transform(fx.housing_like(spark, sf))
    out = features.standardize("raw", "scaled").fit(df).transform(df)
    arr = vector_to_array(F.col("scaled"))
    return out.select("o_orderkey", *[F.round(arr[i], 6).alias(f"s{i}") for i in range(len(STD_COLS))])


@register("min_max_scale", W_HOUSE + " SELECT o_orderkey, " + ", ".join(
    f"round(({c} - (SELECT min({c}) FROM housing)) / ((SELECT max({c}) FROM housing) - (SELECT min({c}) FROM housing)), 6) AS {c}"
    for c in STD_COLS) + " FROM housing")
def q_min_max(spark, sf):
    df = fx.housing_like(spark, sf)
    stats = features.fit_min_max_columns(df, STD_COLS)
    return features.apply_min_max_columns(df, stats).select("o_orderkey", *[_r(c) for c in STD_COLS])


# ---------------------------------------------------------------- text

def _sq(s: str) -> str:
    return s.replace("'", "''")


def _sql_contractions(expr: str) -> str:
    for pat, rep in tf.CONTRACTIONS:
        expr = f"regexp_replace({expr}, '{_sq(pat)}', '{_sq(rep)}', 'g')"
    return expr


SQL_CLEAN = f"translate(regexp_replace({_sql_contractions('text')}, '{tf.DIGITS_PATTERN}', '{tf.DIGITS_WORD}', 'g'), '{_sq(tf.PUNCTUATION)}', '')"
SQL_SPLIT = f"list_filter(regexp_split_to_array(lower({SQL_CLEAN}), '{tf.WHITESPACE_CLASS}'), lambda x: x <> '')"
SQL_STOPS = "[" + ", ".join(f"'{_sq(w)}'" for w in tf.STOPWORDS) + "]"
SQL_TOKENS = f"list_filter({SQL_SPLIT}, lambda x: NOT list_contains({SQL_STOPS}, x))"
DOCS_TOKENS_SQL = f"toks AS (SELECT doc_id, {SQL_TOKENS} AS tokens FROM documents)"


def _docs_tokens(spark, sf):
    """Cleaned tokens, written once: the corpus operators below make several passes over them."""
    ensure_checkpoint_dir(spark)
    toks = text.clean_text(fx.text_like(spark, sf), "text", "tokens", stemming=False)
    return toks.select("doc_id", "tokens").checkpoint(eager=True)


@register("expand_contractions", f"SELECT doc_id, {_sql_contractions('text')} AS text FROM documents")
def q_contractions(spark, sf):
    return fx.text_like(spark, sf).select("doc_id", tf.expand_contractions("text").alias("text"))


@register("mask_digits", f"SELECT doc_id, regexp_replace(text, '{tf.DIGITS_PATTERN}', 'digits', 'g') AS text FROM documents")
def q_mask_digits(spark, sf):
    return fx.text_like(spark, sf).select("doc_id", tf.mask_digits("text").alias("text"))


@register("strip_punctuation", f"SELECT doc_id, translate(text, '{_sq(tf.PUNCTUATION)}', '') AS text FROM documents")
def q_strip_punct(spark, sf):
    return fx.text_like(spark, sf).select("doc_id", tf.strip_punctuation("text").alias("text"))


@register("normalize_ws_lower", f"SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '{tf.WHITESPACE_CLASS}'), lambda x: x <> ''), ' ') AS tokens FROM documents")
def q_norm_ws(spark, sf):
    return fx.text_like(spark, sf).select("doc_id", F.array_join(tf.normalize_ws_lower("text"), " ").alias("tokens"))


@register("remove_stopwords", f"SELECT doc_id, array_to_string(list_filter(list_filter(regexp_split_to_array(lower(text), '{tf.WHITESPACE_CLASS}'), lambda x: x <> ''), lambda x: NOT list_contains({SQL_STOPS}, x)), ' ') AS tokens FROM documents")
def q_stopwords(spark, sf):
    return fx.text_like(spark, sf).select("doc_id", F.array_join(tf.remove_stopwords(tf.normalize_ws_lower("text")), " ").alias("tokens"))


@register("clean_text", f"SELECT doc_id, array_to_string({SQL_TOKENS}, ' ') AS tokens FROM documents")
def q_clean_text(spark, sf):
    return _docs_tokens(spark, sf).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@register("tokenize", f"SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '{tf.WHITESPACE_CLASS}'), lambda x: length(x) >= 2), ' ') AS tokens FROM documents")
def q_tokenize(spark, sf):
    return fx.text_like(spark, sf).select("doc_id", F.array_join(tf.tokenize("text", 2), " ").alias("tokens"))


@register("stem", f"""WITH tk AS (SELECT doc_id, {SQL_TOKENS} AS tokens FROM documents),
  pt AS (SELECT doc_id, unnest(tokens) AS term, unnest(generate_series(1, len(tokens))) AS pos FROM tk),
  st AS (SELECT term, stem FROM {stem_sql("(SELECT DISTINCT term FROM pt)")}),
  sj AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS tokens FROM pt JOIN st USING (term) GROUP BY doc_id)
  SELECT tk.doc_id, coalesce(sj.tokens, '') AS tokens FROM tk LEFT JOIN sj USING (doc_id)""")
def q_stem(spark, sf):
    """T6 of the cleaned documents."""
    return text.clean_text(fx.text_like(spark, sf), "text", "tokens", stemming=True).select(
        "doc_id", F.array_join("tokens", " ").alias("tokens")
    )


VOCAB_SQL = DOCS_TOKENS_SQL + """, dt AS (SELECT doc_id, unnest(tokens) AS term FROM toks),
  st AS (SELECT term, count(*) AS term_count, count(DISTINCT doc_id) AS doc_freq FROM dt WHERE length(term) >= 2 GROUP BY term),
  nd AS (SELECT count(DISTINCT doc_id) AS n FROM documents),
  vf AS (SELECT term, term_count, doc_freq FROM st, nd WHERE doc_freq >= 2 AND doc_freq <= 0.95 * n
         ORDER BY term_count DESC, term LIMIT 50000),
  vocab AS (SELECT term, term_count, doc_freq, (row_number() OVER (ORDER BY term) - 1) AS term_index FROM vf)"""


@register("count_vectorize", "WITH " + VOCAB_SQL + " SELECT term, term_count, doc_freq, term_index FROM vocab")
def q_count_vectorize(spark, sf):
    v = text.count_vectorize(_docs_tokens(spark, sf), "doc_id", "tokens")
    return v.select("term", "term_count", "doc_freq", F.col("term_index").cast("long").alias("term_index"))


@register("tfidf", "WITH " + VOCAB_SQL + """, tfq AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY doc_id, term),
  w AS (SELECT doc_id, tfq.term, tf * (ln((1 + nd.n) / (1 + doc_freq::DOUBLE)) + 1) AS w FROM tfq JOIN vocab ON tfq.term = vocab.term, nd)
  SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf(spark, sf):
    toks = _docs_tokens(spark, sf)
    vocab = text.count_vectorize(toks, "doc_id", "tokens")
    return text.tfidf(toks, "doc_id", "tokens", vocab, toks.count()).select("doc_id", "term", _r("weight"))


BUILD_VOCAB_SQL = DOCS_TOKENS_SQL + """, bv AS (SELECT term, count(*) AS term_count FROM (SELECT unnest(tokens) AS term FROM toks) GROUP BY term),
  vocab AS (SELECT term, term_count, row_number() OVER (ORDER BY term_count DESC, term) + 1 AS term_id FROM bv)"""


@register("build_vocabulary", "WITH " + BUILD_VOCAB_SQL + " SELECT term, term_count, term_id FROM vocab")
def q_build_vocab(spark, sf):
    return text.build_vocabulary(_docs_tokens(spark, sf), "tokens")


@register("rank_terms", "WITH " + BUILD_VOCAB_SQL + " SELECT term, term_count, term_id - 1 AS rank FROM vocab")
def q_rank_terms(spark, sf):
    return text.rank_terms(text.build_vocabulary(_docs_tokens(spark, sf), "tokens"))


SEQ_SQL = BUILD_VOCAB_SQL + """, pt AS (SELECT doc_id, unnest(tokens) AS term, unnest(generate_series(1, len(tokens))) AS pos FROM toks),
  ids AS (SELECT doc_id, pos, coalesce(term_id, 1)::INTEGER AS id FROM pt LEFT JOIN vocab USING (term)),
  seqs AS (SELECT d.doc_id, coalesce(list(id ORDER BY pos) FILTER (WHERE id IS NOT NULL), []::INTEGER[]) AS seq
           FROM documents d LEFT JOIN ids ON d.doc_id = ids.doc_id GROUP BY d.doc_id)"""


@register("encode_sequence", "WITH " + SEQ_SQL + " SELECT doc_id, array_to_string(seq, ' ') AS seq FROM seqs")
def q_encode_seq(spark, sf):
    toks = _docs_tokens(spark, sf)
    vocab = text.build_vocabulary(toks, "tokens")
    s = text.encode_sequence(toks, "doc_id", "tokens", vocab)
    return s.select("doc_id", F.array_join("seq", " ").alias("seq"))


# every row is a document, also where an id repeats or is missing
REPEATED = "nullif(lang, 'en')"


def _repeated_tokens(spark, sf):
    ensure_checkpoint_dir(spark)
    toks = text.clean_text(fx.table(spark, sf, "documents"), "text", "tokens", stemming=False)
    return toks.select(F.expr(REPEATED).alias("grp"), "tokens").checkpoint(eager=True)


ROWS_SQL = f"""rw AS (SELECT row_number() OVER () AS r, {REPEATED} AS grp, {SQL_TOKENS} AS tokens FROM documents),
  pt AS (SELECT r, grp, unnest(tokens) AS term, unnest(generate_series(1, len(tokens))) AS pos FROM rw)"""


@register("tfidf_repeated_ids", "WITH " + ROWS_SQL + """, nd AS (SELECT count(*) AS n FROM rw),
  st AS (SELECT term, count(*) AS term_count, count(DISTINCT r) AS doc_freq FROM pt WHERE length(term) >= 2 GROUP BY term),
  vf AS (SELECT term, doc_freq FROM st, nd WHERE doc_freq >= 2 AND doc_freq <= 0.95 * n ORDER BY term_count DESC, term LIMIT 50000),
  tfq AS (SELECT r, grp, term, count(*) AS tf FROM pt GROUP BY r, grp, term),
  w AS (SELECT r, grp, term, tf * (ln((1 + nd.n) / (1 + doc_freq::DOUBLE)) + 1) AS w FROM tfq JOIN vf USING (term), nd)
  SELECT grp, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY r)), 6) AS weight FROM w""")
def q_tfidf_repeated(spark, sf):
    """T10 where the language stands in for the id: repeated for most rows, null for the others."""
    toks = _repeated_tokens(spark, sf)
    vocab = text.count_vectorize(toks, "grp", "tokens")
    return text.tfidf(toks, "grp", "tokens", vocab, toks.count()).select("grp", "term", _r("weight"))


@register("encode_sequence_repeated_ids", "WITH " + ROWS_SQL + """, bv AS (SELECT term, count(*) AS term_count FROM pt GROUP BY term),
  vocab AS (SELECT term, row_number() OVER (ORDER BY term_count DESC, term) + 1 AS term_id FROM bv)
  SELECT any_value(rw.grp) AS grp, coalesce(string_agg(term_id, ' ' ORDER BY pos), '') AS seq
  FROM rw LEFT JOIN pt USING (r) LEFT JOIN vocab USING (term) GROUP BY r""")
def q_encode_repeated(spark, sf):
    """T13 with the same ids."""
    toks = _repeated_tokens(spark, sf)
    s = text.encode_sequence(toks, "grp", "tokens", text.build_vocabulary(toks, "tokens"))
    return s.select("grp", F.array_join("seq", " ").alias("seq"))


@register("pad_sequences", "WITH " + SEQ_SQL + """, tr AS (SELECT doc_id, list_transform(seq, lambda x: CASE WHEN x >= 5000 THEN 0 ELSE x END) AS s FROM seqs)
  SELECT doc_id, array_to_string(list_concat(list_transform(range(greatest(200 - len(s), 0)), lambda x: 0),
         list_slice(s, greatest(len(s) - 200 + 1, 1), len(s))), ' ') AS padded FROM tr""")
def q_pad(spark, sf):
    toks = _docs_tokens(spark, sf)
    vocab = text.build_vocabulary(toks, "tokens")
    s = text.encode_sequence(toks, "doc_id", "tokens", vocab, last=200)
    return text.sequence_matrix(s, "seq", 5000, 200).select("doc_id", F.array_join("padded", " ").alias("padded"))


# ---------------------------------------------------------------- evaluation

W_SCORE = "WITH " + fx.SCORE_SQL


def _roc_sql(score: str) -> str:
    return W_SCORE + f""", g AS (SELECT {score}::DOUBLE AS threshold, sum(label) AS tp, sum(1 - label) AS fp FROM scored GROUP BY {score}),
  c AS (SELECT threshold, tp, fp, sum(tp) OVER (ORDER BY threshold DESC) AS cum_tp, sum(fp) OVER (ORDER BY threshold DESC) AS cum_fp,
        sum(tp) OVER () AS P, sum(fp) OVER () AS N FROM g)"""


@register("roc_points", _roc_sql("score") + """ SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, cum_tp::BIGINT AS cum_tp,
  cum_fp::BIGINT AS cum_fp, round(cum_tp / P, 9) AS tpr, round(cum_fp / N, 9) AS fpr FROM c""")
def q_roc(spark, sf):
    r = evaluate.roc_points(fx.score_like(spark, sf), "score", "label")
    return r.select("threshold", "tp", "fp", "cum_tp", "cum_fp", _r("tpr", 9), _r("fpr", 9))


@register("roc_points_ties", _roc_sql("score_ties") + """ SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, cum_tp::BIGINT AS cum_tp,
  cum_fp::BIGINT AS cum_fp, round(cum_tp / P, 9) AS tpr, round(cum_fp / N, 9) AS fpr FROM c""")
def q_roc_ties(spark, sf):
    r = evaluate.roc_points(fx.score_like(spark, sf), "score_ties", "label")
    return r.select("threshold", "tp", "fp", "cum_tp", "cum_fp", _r("tpr", 9), _r("fpr", 9))


SPARSE_SQL = """, k AS (SELECT *, lead(tp) OVER o AS ntp, lead(fp) OVER o AS nfp, row_number() OVER o AS r FROM c WINDOW o AS (ORDER BY threshold DESC))
  SELECT threshold, cum_tp::BIGINT AS cum_tp, cum_fp::BIGINT AS cum_fp, round(cum_tp / P, 9) AS tpr, round(cum_fp / N, 9) AS fpr
  FROM k WHERE r = 1 OR ntp IS NULL OR ntp <> tp OR nfp <> fp"""


@register("roc_points_sparse", _roc_sql("score") + SPARSE_SQL)
def q_roc_sparse(spark, sf):
    """E2 without the points inside straight lines."""
    r = evaluate.roc_points(fx.score_like(spark, sf), "score", "label", drop_intermediate=True)
    return r.select("threshold", "cum_tp", "cum_fp", _r("tpr", 9), _r("fpr", 9))


@register("roc_points_ties_sparse", _roc_sql("score_ties") + SPARSE_SQL)
def q_roc_ties_sparse(spark, sf):
    r = evaluate.roc_points(fx.score_like(spark, sf), "score_ties", "label", drop_intermediate=True)
    return r.select("threshold", "cum_tp", "cum_fp", _r("tpr", 9), _r("fpr", 9))


def _auc_sql(score: str) -> str:
    return _roc_sql(score) + " SELECT round(sum(fp * ((cum_tp - tp) + tp / 2.0)) / (max(P) * max(N)), 9) AS auc FROM c"


@register("auc", _auc_sql("score"))
def q_auc(spark, sf):
    return evaluate.auc(fx.score_like(spark, sf), "score", "label").select(_r("auc", 9))


@register("auc_ties", _auc_sql("score_ties"))
def q_auc_ties(spark, sf):
    return evaluate.auc(fx.score_like(spark, sf), "score_ties", "label").select(_r("auc", 9))


HARD = "CASE WHEN score > 38000 THEN 1 ELSE 0 END"


@register("auc_hard", W_SCORE + f""" SELECT round(((count_if(label = 1 AND {HARD} = 1)::DOUBLE / count_if(label = 1))
  + (count_if(label <> 1 AND {HARD} <> 1)::DOUBLE / count_if(label <> 1))) / 2, 9) AS auc_hard FROM scored""")
def q_auc_hard(spark, sf):
    df = fx.score_like(spark, sf).withColumn("pred", (F.col("score") > 38000).cast("int"))
    return evaluate.auc_hard(df, "pred", "label").select(_r("auc_hard", 9))


@register("compare_roc", W_SCORE + """, lm AS (SELECT 'price' AS model, score AS s, label FROM scored UNION ALL
  SELECT 'quantity' AS model, score_ties AS s, label FROM scored),
  g AS (SELECT model, s AS threshold, sum(label) AS tp, sum(1 - label) AS fp FROM lm GROUP BY model, s),
  c AS (SELECT model, tp, fp, sum(tp) OVER (PARTITION BY model ORDER BY threshold DESC) AS cum_tp,
        sum(tp) OVER (PARTITION BY model) AS P, sum(fp) OVER (PARTITION BY model) AS N FROM g)
  SELECT model, round(sum(fp * ((cum_tp - tp) + tp / 2.0)) / (max(P) * max(N)), 9) AS auc FROM c GROUP BY model""")
def q_compare(spark, sf):
    s = fx.score_like(spark, sf)
    _, a = evaluate.compare_roc(
        {"price": s.select("score", "label"), "quantity": s.select(F.col("score_ties").alias("score"), "label")}, "score", "label"
    )
    return a.select("model", _r("auc", 9))


@register("compare_roc_points", W_SCORE + """, lm AS (SELECT 'price' AS model, score AS s, label FROM scored UNION ALL
  SELECT 'quantity' AS model, score_ties AS s, label FROM scored),
  g AS (SELECT model, s AS threshold, sum(label) AS tp, sum(1 - label) AS fp FROM lm GROUP BY model, s),
  c AS (SELECT model, threshold, sum(tp) OVER (PARTITION BY model ORDER BY threshold DESC) AS cum_tp,
        sum(fp) OVER (PARTITION BY model ORDER BY threshold DESC) AS cum_fp,
        sum(tp) OVER (PARTITION BY model) AS P, sum(fp) OVER (PARTITION BY model) AS N FROM g)
  SELECT model, threshold, round(cum_tp / P, 9) AS tpr, round(cum_fp / N, 9) AS fpr FROM c""")
def q_compare_points(spark, sf):
    s = fx.score_like(spark, sf)
    pts, _ = evaluate.compare_roc(
        {"price": s.select("score", "label"), "quantity": s.select(F.col("score_ties").alias("score"), "label")}, "score", "label"
    )
    return pts.select("model", "threshold", _r("tpr", 9), _r("fpr", 9))


@register("accuracy", W_SCORE + f" SELECT round(avg(CASE WHEN {HARD} = label THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM scored")
def q_accuracy(spark, sf):
    df = fx.score_like(spark, sf).withColumn("pred", (F.col("score") > 38000).cast("int"))
    return evaluate.accuracy(df, "pred", "label").select(_r("accuracy", 9))


NAIVE_PRED = "n_lines * 40.0"


def _house_pred(spark, sf):
    return fx.housing_like(spark, sf).withColumn("pred", F.col("n_lines") * 40.0)


@register("mae", W_HOUSE + f" SELECT round(avg(abs(price_k - {NAIVE_PRED})), 6) AS mae FROM housing")
def q_mae(spark, sf):
    return evaluate.mae(_house_pred(spark, sf), "pred", "price_k").select(_r("mae"))


@register("r2", W_HOUSE + f" SELECT round(1 - sum((price_k - {NAIVE_PRED}) * (price_k - {NAIVE_PRED})) / (count(price_k) * var_pop(price_k)), 6) AS r2 FROM housing")
def q_r2(spark, sf):
    return evaluate.r2(_house_pred(spark, sf), "pred", "price_k").select(_r("r2"))


@register("residuals", W_HOUSE + f""" SELECT o_orderkey, price_k, {NAIVE_PRED} AS pred, round(price_k - {NAIVE_PRED}, 6) AS error,
  round(abs(price_k - {NAIVE_PRED}), 6) AS abs_error FROM housing""")
def q_residuals(spark, sf):
    r = evaluate.residuals(_house_pred(spark, sf), "pred", "price_k", ["o_orderkey"])
    return r.select("o_orderkey", "price_k", "pred", _r("error"), _r("abs_error"))


@register("confusion_matrix", W_SCORE + f" SELECT label, {HARD} AS prediction, count(*) AS count FROM scored GROUP BY ALL")
def q_confusion(spark, sf):
    df = fx.score_like(spark, sf).withColumn("pred", (F.col("score") > 38000).cast("int"))
    return evaluate.confusion_matrix(df, "pred", "label")


@register("pr_points", _roc_sql("score_ties") + " SELECT threshold, round(cum_tp / (cum_tp + cum_fp), 9) AS precision, round(cum_tp / P, 9) AS recall FROM c")
def q_pr(spark, sf):
    p = evaluate.pr_points(fx.score_like(spark, sf), "score_ties", "label")
    return p.select("threshold", _r("precision", 9), _r("recall", 9))


@register("best_threshold", _roc_sql("score_ties") + """, j AS (SELECT threshold, cum_tp / P AS tpr, cum_fp / N AS fpr, cum_tp / P - cum_fp / N AS j FROM c)
  SELECT threshold, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr, round(j, 9) AS j FROM j ORDER BY j DESC, threshold DESC LIMIT 1""")
def q_best_threshold(spark, sf):
    b = evaluate.best_threshold(fx.score_like(spark, sf), "score_ties", "label")
    return b.select("threshold", _r("tpr", 9), _r("fpr", 9), _r("j", 9))


@register("residual_by_bucket", W_HOUSE + f""", b AS (SELECT price_k, {NAIVE_PRED} AS pred, ntile(10) OVER (ORDER BY price_k, o_orderkey) AS bucket FROM housing)
  SELECT bucket::INTEGER AS bucket, count(*) AS count, round(min(price_k), 6) AS label_min, round(max(price_k), 6) AS label_max,
  round(avg(price_k - pred), 6) AS mean_error, round(avg(abs(price_k - pred)), 6) AS mean_abs_error FROM b GROUP BY bucket""")
def q_res_bucket(spark, sf):
    r = evaluate.residual_by_bucket(_house_pred(spark, sf), "pred", "price_k", 10, ["o_orderkey"])
    return r.select("bucket", "count", _r("label_min"), _r("label_max"), _r("mean_error"), _r("mean_abs_error"))
