"""Catalog entries: ensembles over the prediction table (§2.10 combiners)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..session import cut_lineage
from . import tables as tb, ensembles as en
from .catalog import query, R, WITH_PREDS
from .q_evaluate import _grid_values_sql, _metrics_sql, METRIC_COLS

EKEYS = ["imputation", "version"]
EK = "imputation, version"
LINSPACE = [float(x) for x in __import__("numpy").linspace(0.2, 0.8, 61)]


MP_SQL = f""", mp AS (SELECT row_id, {EK}, split, y, avg(score) AS score FROM preds GROUP BY row_id, {EK}, split, y)
"""


@query("mean_probability", R(WITH_PREDS + MP_SQL + f""", gr(grid_idx, threshold) AS ({_grid_values_sql(LINSPACE)}),
gc AS (SELECT {EK}, grid_idx, threshold, count_if(y = 1 AND score >= threshold) AS tp,
   count_if(y <> 1 AND score >= threshold) AS fp, count_if(y = 1 AND score < threshold) AS fn,
   count_if(y <> 1 AND score < threshold) AS tn FROM mp CROSS JOIN gr WHERE split = 'val' GROUP BY ALL),
gm AS ({_metrics_sql("SELECT * FROM gc")}),
b AS (SELECT * FROM gm QUALIFY row_number() OVER (PARTITION BY {EK} ORDER BY f1 DESC, grid_idx) = 1),
th AS (SELECT {EK}, CASE WHEN f1 > 0 THEN threshold ELSE 0.5 END AS threshold FROM b),
tc AS (SELECT {EK}, th.threshold, count_if(y <> 1 AND score < th.threshold) AS tn,
   count_if(y <> 1 AND score >= th.threshold) AS fp, count_if(y = 1 AND score < th.threshold) AS fn,
   count_if(y = 1 AND score >= th.threshold) AS tp FROM mp JOIN th USING ({EK}) WHERE split = 'test' GROUP BY ALL)
SELECT {EK}, threshold, tn, fp, fn, tp, f1, precision, recall FROM ({_metrics_sql("SELECT * FROM tc")})""",
    ["threshold", "f1", "precision", "recall"]))
def q_mean_probability(spark, d):
    """Mean of the five members' probabilities; threshold from a 61-point validation grid."""
    mp = cut_lineage(en.mean_probability(tb.preds(spark, d).where(F.col("split").isin("val", "test")), [*EKEYS, "split"]))
    th = ev.best_threshold_grid(mp.where("split = 'val'"), EKEYS, thresholds=LINSPACE).select(*EKEYS, "threshold")
    test = mp.where("split = 'test'").join(th, EKEYS)
    m = ev.metrics_from_counts(ev.confusion_counts(ev.with_prediction(test, F.col("threshold")), EKEYS + ["threshold"]))
    return m.select(*EKEYS, "threshold", "tn", "fp", "fn", "tp", "f1", "precision", "recall")


@query("vote", R(WITH_PREDS + f"""SELECT row_id, {EK}, y,
  sum(CASE model WHEN 'XGBoost' THEN 2.0 WHEN 'GradBoost' THEN 1.0 WHEN 'RandForest' THEN 1.0 ELSE 0.0 END * score)
    / sum(CASE model WHEN 'XGBoost' THEN 2.0 WHEN 'GradBoost' THEN 1.0 WHEN 'RandForest' THEN 1.0 ELSE 0.0 END) AS soft,
  CAST(sum(CASE model WHEN 'XGBoost' THEN 2.0 WHEN 'GradBoost' THEN 1.0 WHEN 'RandForest' THEN 1.0 ELSE 0.0 END * CAST(score >= 0.5 AS DOUBLE))
     > sum(CASE model WHEN 'XGBoost' THEN 2.0 WHEN 'GradBoost' THEN 1.0 WHEN 'RandForest' THEN 1.0 ELSE 0.0 END * (1 - CAST(score >= 0.5 AS DOUBLE))) AS INTEGER) AS hard
  FROM preds WHERE split = 'test' GROUP BY row_id, {EK}, y""", ["soft"]))
def q_vote(spark, d):
    """Weighted soft and hard votes of three members (weights 2, 1, 1; others 0)."""
    p = tb.preds(spark, d).where(F.col("split") == "test")
    return en.vote(p, EKEYS, weights={"XGBoost": 2, "GradBoost": 1, "RandForest": 1})


@query("blend", R(WITH_PREDS + f"""SELECT row_id, {EK}, y,
  sum(0.5 * score) AS blended, CAST(sum(0.5 * score) >= 0.42 AS INTEGER) AS pred
  FROM preds WHERE split = 'test' AND model IN ('XGBoost', 'GradBoost') GROUP BY row_id, {EK}, y""", ["blended"]))
def q_blend(spark, d):
    p = tb.preds(spark, d).where(F.col("split") == "test")
    return en.blend(p, {"XGBoost": 0.5, "GradBoost": 0.5}, keys=EKEYS, threshold=0.42)


OPT_MODELS = ["XGBoost", "GradBoost", "RandForest"]


def _opt_sql():
    grid = en.weight_grid(OPT_MODELS, (1, 2, 3))
    vals = ", ".join(f"({i}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE))" for i, (a, b, c) in enumerate(grid))
    return WITH_PREDS + f""", pv AS (SELECT row_id, {EK}, y,
   max(CASE WHEN model = 'XGBoost' THEN score END) AS XGBoost, max(CASE WHEN model = 'GradBoost' THEN score END) AS GradBoost,
   max(CASE WHEN model = 'RandForest' THEN score END) AS RandForest
   FROM preds WHERE split = 'val' AND model IN ('XGBoost', 'GradBoost', 'RandForest') GROUP BY row_id, {EK}, y),
wg(combo, w_XGBoost, w_GradBoost, w_RandForest) AS (VALUES {vals}),
ex AS (SELECT pv.*, wg.*, CAST((0.0 + w_XGBoost * XGBoost + w_GradBoost * GradBoost + w_RandForest * RandForest)
   / (0.0 + w_XGBoost + w_GradBoost + w_RandForest) >= 0.5 AS INTEGER) AS pred FROM pv CROSS JOIN wg),
cc AS (SELECT {EK}, combo, w_XGBoost, w_GradBoost, w_RandForest, count_if(y <> 1 AND pred <> 1) AS tn,
   count_if(y <> 1 AND pred = 1) AS fp, count_if(y = 1 AND pred <> 1) AS fn, count_if(y = 1 AND pred = 1) AS tp
   FROM ex GROUP BY ALL)
SELECT {EK}, combo, w_XGBoost, w_GradBoost, w_RandForest, f1, precision, recall FROM ({_metrics_sql("SELECT * FROM cc")})"""


@query("optimise_ensemble", R(_opt_sql(), ["w_XGBoost", "w_GradBoost", "w_RandForest", "f1", "precision", "recall"]))
def q_optimise_ensemble(spark, d):
    p = tb.preds(spark, d).where(F.col("split") == "val")
    return en.optimise_ensemble(p, OPT_MODELS, EKEYS)
