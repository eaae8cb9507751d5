"""Study inputs derived from the driver tables, defined twice: as Spark DataFrames and as
SQL CTEs for the DuckDB oracle. Both must produce identical rows.

* ``study``  – one row per lineitem: row_id, continuous X1..X3 with injected nulls,
               binary X4..X10 (X6 = X7 duplicated, X10 constant), target y (~15 % ones).
* ``preds``  – long prediction table: each lineitem row scored by five models,
               keys (model, imputation, version), split train/val/test by portable hash,
               score in [0, 1) with ties (multiples of 0.001).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import portable_hash, row_key

KEYS = ["model", "imputation", "version"]
CONTINUOUS = ["X1", "X2", "X3"]
BINARY = ["X4", "X5", "X6", "X7", "X8", "X9", "X10"]
FEATURES = CONTINUOUS + BINARY

# Fixed values of the fixture: model name, index, signal strength (per mille).
MODELS = [("RandForest", 0, 300), ("GradBoost", 1, 350), ("XGBoost", 2, 400),
          ("SVM", 3, 250), ("MLP", 4, 200)]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _row_id() -> F.Column:
    price = F.round(F.col("l_extendedprice") * 100).cast("long")
    return row_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long"), price)


def _target() -> F.Column:
    return ((F.col("l_returnflag") == "R") & (F.col("l_discount") < 0.05)).cast("int")


def study(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    c = F.col
    return li.select(
        _row_id().alias("row_id"),
        F.when(c("l_partkey") % 4 == 0, None).otherwise(c("l_extendedprice") * c("l_discount")).alias("X1"),
        F.when(c("l_suppkey") % 5 == 0, None).otherwise(c("l_quantity")).alias("X2"),
        F.when(c("l_orderkey") % 7 == 0, None).otherwise(c("l_tax") * 100).alias("X3"),
        F.when(c("l_linenumber") == 7, None).otherwise((c("l_linestatus") == "F").cast("double")).alias("X4"),
        (c("l_discount") >= 0.05).cast("int").alias("X5"),
        (c("l_quantity") > 45).cast("int").alias("X6"),
        (c("l_quantity") > 45).cast("int").alias("X7"),
        (c("l_tax") == 0).cast("int").alias("X8"),
        (c("l_partkey") % 50 == 0).cast("int").alias("X9"),
        (c("l_quantity") > 1000).cast("int").alias("X10"),
        _target().alias("y"))


STUDY_SQL = """study AS (
  SELECT CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15)) AS BIGINT) AS row_id,
         CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE l_extendedprice * l_discount END AS X1,
         CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_quantity END AS X2,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax * 100 END AS X3,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linestatus = 'F' AS DOUBLE) END AS X4,
         CAST(l_discount >= 0.05 AS INTEGER) AS X5,
         CAST(l_quantity > 45 AS INTEGER) AS X6,
         CAST(l_quantity > 45 AS INTEGER) AS X7,
         CAST(l_tax = 0 AS INTEGER) AS X8,
         CAST(l_partkey % 50 = 0 AS INTEGER) AS X9,
         CAST(l_quantity > 1000 AS INTEGER) AS X10,
         CAST(l_returnflag = 'R' AND l_discount < 0.05 AS INTEGER) AS y
  FROM lineitem)"""


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    base = li.select(_row_id().alias("row_id"), _target().alias("y"),
                     F.when(F.col("l_linestatus") == "F", "KNN").otherwise("MICE").alias("imputation"),
                     F.when(F.col("l_linenumber") <= 4, "FULL").otherwise("REDUCED").alias("version"))
    base = base.select("*", portable_hash("row_id", 42).alias("_h1"), portable_hash("row_id", 7).alias("_h2"))
    u = F.col("_h1") / F.lit(4294967296.0)
    split = F.when(u < 0.6, "train").when(u < 0.8, "val").otherwise("test")
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(k).alias("_k"), F.lit(s).alias("_sig"))
                       for m, k, s in MODELS])
    ex = base.select("*", split.alias("split"), F.inline(models))
    noise = (F.col("_h2") * (2 * F.col("_k") + 1) + 7919 * F.col("_k")) % (1000 - F.col("_sig"))
    score = (F.col("_sig") * F.col("y") + noise).cast("double") / F.lit(1000.0)
    return ex.select("row_id", "model", "imputation", "version", "split", "y", score.alias("score"))


PREDS_SQL = """preds_base AS (
  SELECT CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT))), 1, 15)) AS BIGINT) AS row_id,
         CAST(l_returnflag = 'R' AND l_discount < 0.05 AS INTEGER) AS y,
         CASE WHEN l_linestatus = 'F' THEN 'KNN' ELSE 'MICE' END AS imputation,
         CASE WHEN l_linenumber <= 4 THEN 'FULL' ELSE 'REDUCED' END AS version
  FROM lineitem),
preds_h AS (
  SELECT *, CAST(('0x' || substr(md5('42|' || CAST(row_id AS VARCHAR)), 1, 8)) AS BIGINT) AS h1,
            CAST(('0x' || substr(md5('7|' || CAST(row_id AS VARCHAR)), 1, 8)) AS BIGINT) AS h2
  FROM preds_base),
models(model, k, sig) AS (VALUES """ + ", ".join(f"('{m}', {k}, {s})" for m, k, s in MODELS) + """),
preds AS (
  SELECT row_id, model, imputation, version,
         CASE WHEN CAST(h1 AS DOUBLE) / 4294967296.0 < 0.6 THEN 'train' WHEN CAST(h1 AS DOUBLE) / 4294967296.0 < 0.8 THEN 'val' ELSE 'test' END AS split,
         y, CAST(sig * y + (h2 * (2 * k + 1) + 7919 * k) % (1000 - sig) AS DOUBLE) / 1000.0 AS score
  FROM preds_h CROSS JOIN models)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
