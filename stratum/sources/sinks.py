"""Sinks: tables, parameters, label files, result documents."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.scalar import qcol
from ..operators.params import PARAMS_SCHEMA


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV or Parquet chosen by the path suffix; anything else is an error."""
    p = path.rstrip("/").lower()
    if p.endswith(".parquet") or p.endswith(".pq"):
        df.write.mode(mode).parquet(path)
    elif p.endswith(".csv"):
        df.write.mode(mode).option("header", True).csv(path)
    else:
        raise ValueError(f"unsupported table format: {path!r} (use .csv or .parquet)")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    p = path.rstrip("/").lower()
    if p.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    return spark.read.parquet(path)


def save_params(params: DataFrame, path: str) -> None:
    params.write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAMS_SCHEMA).parquet(path)


def write_label_lines(df: DataFrame, path: str, label: str = "outcome", order: str = "row_id",
                      with_id: bool = False) -> None:
    """Header-less label file in ``order``: range-partitioned part files written in order
    (concatenating part-00000, part-00001, ... gives the file); ``with_id`` writes the
    ``id,outcome`` CSV form with a header instead."""
    o = df.orderBy(qcol(order))
    if with_id:
        o.select(qcol(order).alias("id"), qcol(label).alias("outcome")).write.mode("overwrite") \
         .option("header", True).csv(path)
    else:
        o.select(qcol(label).cast("string")).write.mode("overwrite").text(path)


# Result documents: {method, threshold, performance{...}, predictions{...}}.
RESULT_DOC_SCHEMA = T.StructType([
    T.StructField("method", T.StringType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("optimal_threshold", T.DoubleType()),
    T.StructField("performance", T.StructType([
        T.StructField(n, T.DoubleType()) for n in
        ["f1_score_val", "precision_val", "recall_val", "f1_score_test", "precision_test", "recall_test"]
    ] + [T.StructField("confusion_matrix_test", T.ArrayType(T.ArrayType(T.LongType())))])),
    T.StructField("predictions", T.StructType([
        T.StructField("test_proba", T.ArrayType(T.DoubleType())),
        T.StructField("test_pred", T.ArrayType(T.IntegerType())),
        T.StructField("validation", T.ArrayType(T.DoubleType())),
        T.StructField("test", T.ArrayType(T.DoubleType())),
    ])),
])


def read_result_documents(spark: SparkSession, path: str, name_filter: str = "stacking",
                          multi_line: bool = True) -> DataFrame:
    """One row per document: source file, method, threshold (``threshold`` or
    ``optimal_threshold``), test metrics preferred over validation ones."""
    docs = (spark.read.option("multiLine", multi_line).schema(RESULT_DOC_SCHEMA).json(path)
                 .withColumn("source", F.input_file_name())
                 .where(F.col("source").contains(name_filter)))
    p = F.col("performance")
    return docs.select("source", "method",
                       F.coalesce("threshold", "optimal_threshold").alias("threshold"),
                       F.coalesce(p["f1_score_test"], p["f1_score_val"]).alias("f1"),
                       p["precision_test"].alias("precision"), p["recall_test"].alias("recall"),
                       "predictions")


def read_predictions_json(spark: SparkSession, path: str, name_filter: str = "stacking",
                          multi_line: bool = True, part: str = "test") -> DataFrame:
    """Per-row stored predictions of each document: (source, method, threshold, position, proba, pred).

    ``part``: ``test`` or ``validation`` (whose labels follow from the threshold)."""
    d = read_result_documents(spark, path, name_filter, multi_line)
    pr = F.col("predictions")
    if part not in ("test", "validation"):
        raise ValueError(f"unknown part {part!r}")
    proba = F.coalesce(pr["test_proba"], pr["test"]) if part == "test" else pr["validation"]
    given = pr["test_pred"] if part == "test" else F.lit(None).cast("array<int>")
    rows = F.transform(proba, lambda x, i: F.struct(x.alias("proba"), F.get(given, i).alias("pred")))
    z = d.select("source", "method", "threshold", F.posexplode_outer(rows).alias("position", "r"))
    return z.select("source", "method", "threshold", "position", F.col("r.proba").alias("proba"),
                    F.coalesce(F.col("r.pred"), (F.col("r.proba") >= F.col("threshold")).cast("int")).alias("pred"))
