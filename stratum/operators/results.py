"""Operators over result tables (one row per model/variant): ranking, champions,
variant comparison, gaps, unions, summaries. Inputs are small, but every operator is a
plain DataFrame plan so it also runs over per-row or per-fold result tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalar import gap_status, qcol

TIE = ("model", "imputation", "version")


def _order(metric, tie, cols):
    return [F.col(metric).desc()] + [F.col(t).asc() for t in tie if t in cols]


def rank_models(results: DataFrame, metric: str = "f1", tie=TIE, out: str = "ranking") -> DataFrame:
    w = Window.orderBy(*_order(metric, tie, results.columns))
    return results.withColumn(out, F.row_number().over(w))


def best_per_group(results: DataFrame, group=("imputation", "version"), metric: str = "f1",
                   tie=("model",)) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*_order(metric, tie, results.columns))
    return results.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def top_n_models(results: DataFrame, n: int = 5, metric: str = "f1", tie=TIE) -> DataFrame:
    return results.orderBy(*_order(metric, tie, results.columns)).limit(n)


def select_champion(results: DataFrame, metric: str = "f1", tie=TIE, default_threshold: float = 0.5) -> DataFrame:
    """Single best row; string keys lower-cased, missing threshold -> default."""
    best = top_n_models(results, 1, metric, tie)
    cols = []
    for c, t in best.dtypes:
        if c == "threshold":
            cols.append(F.coalesce(F.col(c), F.lit(default_threshold)).alias(c))
        elif c in tie and t == "string":
            cols.append(F.lower(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return best.select(*cols)


def select_champions(results: DataFrame, version: str = "FULL", min_f1: float = 0.917, n: int = 4,
                     metric: str = "f1") -> DataFrame:
    f = results.where((F.col("version") == version) & (F.col(metric) >= min_f1))
    return top_n_models(f, n, metric)


def filter_results(results: DataFrame, min_metric: float | None = None, metric: str = "f1",
                   **equals) -> DataFrame:
    cond = F.lit(True)
    for k, v in equals.items():
        cond = cond & (qcol(k) == v)
    if min_metric is not None:
        cond = cond & (F.col(metric) >= min_metric)
    return results.where(cond)


def compare_variants(results: DataFrame, a: str = "KNN", b: str = "MICE", variant: str = "imputation",
                     keys=("model", "version"), metric: str = "f1", tie_label: str = "tie") -> DataFrame:
    """Side by side metric of two variants at equal keys, difference a - b and the winner."""
    p = (results.groupBy(*keys).pivot(variant, [a, b]).agg(F.first(metric))
                .withColumnsRenamed({a: f"{metric}_{a.lower()}", b: f"{metric}_{b.lower()}"}))
    fa, fb = F.col(f"{metric}_{a.lower()}"), F.col(f"{metric}_{b.lower()}")
    return (p.withColumn("difference", fa - fb)
             .withColumn("winner", F.when(fa > fb, a).when(fb > fa, b).when(fa == fb, tie_label)))


def validation_test_gap(val: DataFrame, test: DataFrame, keys=TIE, metric: str = "f1") -> DataFrame:
    keys = list(keys)
    j = (val.select(*keys, F.col(metric).alias(f"{metric}_val"))
            .join(test.select(*keys, F.col(metric).alias(f"{metric}_test")), keys))
    gap = F.col(f"{metric}_val") - F.col(f"{metric}_test")
    return j.withColumn("gap", gap).withColumn("status", gap_status(gap))


def union_results(*tagged: tuple[DataFrame, str], tag_col: str = "source", sort: str | None = "f1") -> DataFrame:
    parts = [df.withColumn(tag_col, F.lit(tag)) for df, tag in tagged]
    u = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return u.orderBy(F.col(sort).desc_nulls_last()) if sort else u


def results_summary(results: DataFrame, metric: str = "f1", gap: str | None = "gap",
                    gap_limit: float = 0.03) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_models"), F.max(metric).alias(f"max_{metric}"),
            F.avg(metric).alias(f"mean_{metric}"), (F.max(metric) - F.min(metric)).alias(f"spread_{metric}"),
            F.avg("threshold").alias("mean_threshold")]
    if gap and gap in results.columns:
        aggs.append(F.count_if(F.abs(F.col(gap)) <= gap_limit).alias("n_small_gap"))
    return results.agg(*aggs)


def export_metrics(results: DataFrame, keys, metrics) -> DataFrame:
    """Wide metrics -> long ``(keys..., metric, value)``."""
    return results.unpivot(list(keys), list(metrics), "metric", "value")


def comparison_table(val: DataFrame, test: DataFrame, keys=TIE, metrics=("f1", "precision", "recall")) -> DataFrame:
    """One row per model: test value preferred, validation value otherwise; tagged by origin."""
    keys = list(keys)
    v = val.select(*keys, *[F.col(m).alias(f"_v_{m}") for m in metrics])
    t = test.select(*keys, *[F.col(m).alias(f"_t_{m}") for m in metrics])
    j = v.join(t, keys, "full")
    return j.select(*keys, *[F.coalesce(f"_t_{m}", f"_v_{m}").alias(m) for m in metrics],
                    F.when(F.col(f"_t_{metrics[0]}").isNotNull(), "test").otherwise("validation").alias("origin"))
