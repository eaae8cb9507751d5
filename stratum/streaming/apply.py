"""Apply fitted parameters to a stream.

Every fitted step except k-NN imputation is a projection with literal parameters (median
fill, capping, power transforms, scaling, polynomial features, MICE replay), so a
``readStream`` DataFrame goes through the same code as a batch one. k-NN needs the training
rows and is not offered on streams.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import clean, features as ft, mice, transform as tf
from ..operators.params import read_params


def apply_params(df: DataFrame, params: DataFrame) -> DataFrame:
    """Replay every stateless step present in ``params`` (order: median, impute_median,
    mice, power transforms, caps, scaling, polynomial features)."""
    steps = {r[0] for r in params.select("step").distinct().collect()}
    meta = read_params(params, "meta").get("", {}) if "meta" in steps else {}
    if meta.get("impute") == "knn":
        raise ValueError("k-NN imputation needs the training rows; apply it in batch")
    x = df
    if "median" in steps:
        x = clean.apply_median(x, params, "median")
    if "impute_median" in steps:
        x = clean.apply_median(x, params, "impute_median")
    if "mice" in steps:
        x = mice.apply_mice(x, params)
    for st in ("yeo-johnson", "box-cox"):
        if st in steps:
            x = tf.apply_power(x, params, st)
    if "cap" in steps:
        x = clean.apply_caps(x, params)
    if "scale" in steps:
        x = clean.apply_scale_std(x, params)
    if "poly_cols" in meta:
        x = ft.polynomial_features(x, meta["poly_cols"].split(","), int(meta.get("degree", 2)))
    return x


def stream_prepare(spark: SparkSession, source_dir: str, schema, params: DataFrame, sink: str = "memory",
                   name: str = "prepared", checkpoint: str | None = None, path: str | None = None):
    """Start ``readStream(parquet) -> apply_params -> writeStream`` and return the query."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    out = apply_params(src, params)
    w = out.writeStream.outputMode("append")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if sink == "memory":
        return w.format("memory").queryName(name).start()
    return w.format(sink).option("path", path).start()
