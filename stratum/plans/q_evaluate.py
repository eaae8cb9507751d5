"""Catalog entries: evaluation (§2.11) over the long prediction table."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from . import tables as tb
from .catalog import query, R, WITH_PREDS, K, KEYS


def val(spark, d):
    return tb.preds(spark, d).where(F.col("split") == "val")


def test(spark, d):
    return tb.preds(spark, d).where(F.col("split") == "test")


SC_SQL = f""", sc AS (SELECT {K}, score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg
        FROM preds WHERE split = '{{split}}' GROUP BY {K}, score),
cum AS (SELECT {K}, score, pos, neg,
        CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
        CAST(sum(pos) OVER g AS BIGINT) AS n_pos, CAST(sum(neg) OVER g AS BIGINT) AS n_neg
        FROM sc WINDOW w AS (PARTITION BY {K} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       g AS (PARTITION BY {K}))
"""


def cum_sql(split="val"):
    return WITH_PREDS + SC_SQL.replace("{split}", split)


@query("cumulative_counts", cum_sql() + f"SELECT {K}, score, pos, neg, tp, fp, n_pos, n_neg FROM cum")
def q_cumulative_counts(spark, d):
    return ev.cumulative_counts(val(spark, d), KEYS)


@query("roc_curve", R(cum_sql() + f"""SELECT {K}, score AS threshold,
  CASE WHEN n_neg <> 0 THEN CAST(fp AS DOUBLE) / n_neg ELSE 0.0 END AS fpr,
  CASE WHEN n_pos <> 0 THEN CAST(tp AS DOUBLE) / n_pos ELSE 0.0 END AS tpr FROM cum""", ["threshold", "fpr", "tpr"]))
def q_roc_curve(spark, d):
    return ev.roc_curve(val(spark, d), KEYS)


AREAS_SQL = f""", t AS (SELECT {K}, n_pos, n_neg,
   pos * (n_neg - fp + neg / 2.0) AS a,
   pos * (CAST(tp AS DOUBLE) / (tp + fp)) AS ap,
   pos * ((CAST(tp AS DOUBLE) / (tp + fp)) + CASE WHEN (tp - pos) + (fp - neg) > 0
        THEN CAST(tp - pos AS DOUBLE) / ((tp - pos) + (fp - neg)) ELSE 1.0 END) / 2.0 AS tr FROM cum),
ar AS (SELECT {K}, first(n_pos) AS n_pos, first(n_neg) AS n_neg, sum(a) AS s_auc, sum(ap) AS s_ap, sum(tr) AS s_tr
       FROM t GROUP BY {K}),
areas AS (SELECT {K}, n_pos, n_neg,
   CASE WHEN n_pos > 0 AND n_neg > 0 THEN s_auc / (CAST(n_pos AS DOUBLE) * n_neg) END AS auc_roc,
   CASE WHEN n_pos > 0 THEN s_ap / n_pos END AS average_precision,
   CASE WHEN n_pos > 0 THEN s_tr / n_pos END AS pr_auc FROM ar)
"""


@query("roc_auc", R(cum_sql() + AREAS_SQL + f"SELECT {K}, auc_roc FROM areas", ["auc_roc"]))
def q_roc_auc(spark, d):
    return ev.roc_auc(val(spark, d), KEYS)


@query("average_precision", R(cum_sql() + AREAS_SQL + f"SELECT {K}, average_precision, pr_auc FROM areas",
                              ["average_precision", "pr_auc"]))
def q_average_precision(spark, d):
    return ev.average_precision(val(spark, d), KEYS)


@query("pr_curve", R(cum_sql() + f"""SELECT {K}, score AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
  CASE WHEN n_pos > 0 THEN CAST(tp AS DOUBLE) / n_pos ELSE 1.0 END AS recall FROM cum""",
    ["threshold", "precision", "recall"]))
def q_pr_curve(spark, d):
    return ev.pr_curve(val(spark, d), KEYS)


BEST_PR_SQL = f""", pr AS (SELECT {K}, score AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
   CASE WHEN n_pos > 0 THEN CAST(tp AS DOUBLE) / n_pos ELSE 1.0 END AS recall FROM cum),
fe AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f FROM pr),
bst AS (SELECT * FROM fe QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY f DESC, threshold ASC) = 1),
thresholds AS (SELECT {K}, round(threshold, 4) AS threshold,
   round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 4) AS f1,
   round(precision, 4) AS precision, round(recall, 4) AS recall FROM bst)
"""


def thresholds_sql():
    """CTEs ending in ``thresholds`` (validation-optimal thresholds per group)."""
    return cum_sql("val") + BEST_PR_SQL


@query("best_threshold_pr", thresholds_sql() + f"SELECT {K}, threshold, f1, precision, recall FROM thresholds")
def q_best_threshold_pr(spark, d):
    return ev.best_threshold_pr(val(spark, d), KEYS)


@query("confusion_counts", WITH_PREDS + f"""SELECT {K}, count_if(y <> 1 AND score < 0.5) AS tn,
  count_if(y <> 1 AND score >= 0.5) AS fp, count_if(y = 1 AND score < 0.5) AS fn,
  count_if(y = 1 AND score >= 0.5) AS tp FROM preds WHERE split = 'test' GROUP BY {K}""")
def q_confusion_counts(spark, d):
    return ev.confusion_counts(ev.with_prediction(test(spark, d), 0.5), KEYS)


def _metrics_sql(src: str) -> str:
    sd = lambda n, dd: f"CASE WHEN ({dd}) <> 0 THEN CAST({n} AS DOUBLE) / ({dd}) ELSE 0.0 END"
    return f"""SELECT *, {sd('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {sd('tp', 'tp + fp')} AS precision,
  {sd('tp', 'tp + fn')} AS recall, {sd('2 * tp', '2 * tp + fp + fn')} AS f1,
  {sd('tn', 'tn + fp')} AS specificity, {sd('tn', 'tn + fn')} AS npv FROM ({src}) AS _c"""


CC_TEST_SQL = f"""SELECT {K}, count_if(y <> 1 AND score < 0.5) AS tn, count_if(y <> 1 AND score >= 0.5) AS fp,
  count_if(y = 1 AND score < 0.5) AS fn, count_if(y = 1 AND score >= 0.5) AS tp
  FROM preds WHERE split = 'test' GROUP BY {K}"""
METRIC_COLS = ["accuracy", "precision", "recall", "f1", "specificity", "npv"]


@query("basic_metrics", R(cum_sql("test") + AREAS_SQL + f""", m AS ({_metrics_sql(CC_TEST_SQL)})
SELECT m.*, areas.auc_roc, areas.average_precision AS auc_pr FROM m JOIN areas USING ({K})""",
    METRIC_COLS + ["auc_roc", "auc_pr"]))
def q_basic_metrics(spark, d):
    return ev.basic_metrics(test(spark, d), KEYS, threshold=0.5)


@query("evaluate_scores", R(cum_sql("test") + AREAS_SQL + f""", m AS ({_metrics_sql(CC_TEST_SQL)})
SELECT {K}, tn, fp, fn, tp, """ + ", ".join(f"round({c}, 4) AS {c}" for c in METRIC_COLS) +
    f""", round(areas.auc_roc, 4) AS auc_roc, round(areas.average_precision, 4) AS auc_pr FROM m JOIN areas USING ({K})""",
    METRIC_COLS + ["auc_roc", "auc_pr"]))
def q_evaluate_scores(spark, d):
    return ev.evaluate_scores(test(spark, d), KEYS, threshold=0.5)


@query("class_report", R(WITH_PREDS + f""", cc AS ({CC_TEST_SQL}),
per AS (
  SELECT {K}, '0' AS label, CASE WHEN tn + fn <> 0 THEN CAST(tn AS DOUBLE) / (tn + fn) ELSE 0.0 END AS precision,
         CASE WHEN tn + fp <> 0 THEN CAST(tn AS DOUBLE) / (tn + fp) ELSE 0.0 END AS recall,
         CASE WHEN 2 * tn + fn + fp <> 0 THEN CAST(2 * tn AS DOUBLE) / (2 * tn + fn + fp) ELSE 0.0 END AS f1,
         tn + fp AS support FROM cc
  UNION ALL
  SELECT {K}, '1', CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END,
         CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END,
         CASE WHEN 2 * tp + fp + fn <> 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END,
         tp + fn FROM cc)
SELECT {K}, label, precision, recall, f1, support FROM per
UNION ALL
SELECT {K}, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per GROUP BY {K}
UNION ALL
SELECT {K}, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
       sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per GROUP BY {K}""",
    ["precision", "recall", "f1"]))
def q_class_report(spark, d):
    return ev.class_report(ev.with_prediction(test(spark, d), 0.5), KEYS)


def _grid_values_sql(thresholds) -> str:
    return "VALUES " + ", ".join(f"({i}, CAST('{t!r}' AS DOUBLE))" for i, t in enumerate(thresholds))


def grid_metrics_sql(thresholds, split="val") -> str:
    return WITH_PREDS + f""", gr(grid_idx, threshold) AS ({_grid_values_sql(thresholds)}),
gc AS (SELECT {K}, grid_idx, threshold,
   count_if(y = 1 AND score >= threshold) AS tp, count_if(y <> 1 AND score >= threshold) AS fp,
   count_if(y = 1 AND score < threshold) AS fn, count_if(y <> 1 AND score < threshold) AS tn
   FROM preds CROSS JOIN gr WHERE split = '{split}' GROUP BY {K}, grid_idx, threshold),
gm AS ({_metrics_sql("SELECT * FROM gc")})
"""


@query("threshold_sensitivity", R(grid_metrics_sql(ev.SENSITIVITY_GRID) +
    f"SELECT {K}, grid_idx, threshold, tp, fp, fn, tn, " + ", ".join(METRIC_COLS) + " FROM gm",
    ["threshold"] + METRIC_COLS))
def q_threshold_sensitivity(spark, d):
    return ev.threshold_sensitivity(val(spark, d), KEYS)


@query("best_threshold_grid", R(grid_metrics_sql(ev.DEFAULT_GRID) + f""", b AS (
  SELECT * FROM gm QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY f1 DESC, grid_idx ASC) = 1)
SELECT {K}, CASE WHEN f1 > 0 THEN threshold ELSE 0.5 END AS threshold,
       CASE WHEN f1 > 0 THEN f1 ELSE 0.0 END AS best_score, 'f1' AS metric FROM b""", ["threshold", "best_score"]))
def q_best_threshold_grid(spark, d):
    return ev.best_threshold_grid(val(spark, d), KEYS, metric="f1")


@query("calibration_table", R(WITH_PREDS + f"""SELECT {K}, CAST(least(floor(score * 10), 9) AS INTEGER) AS bin,
  avg(score) AS mean_score, avg(CAST(y AS DOUBLE)) AS frac_pos, count(*) AS n_rows
  FROM preds WHERE split = 'val' GROUP BY {K}, 4""".replace(", 4", ", bin"), ["mean_score", "frac_pos"]))
def q_calibration_table(spark, d):
    return ev.calibration_table(val(spark, d), KEYS)


@query("score_histogram_by_class", R(WITH_PREDS + f""", h AS (SELECT {K}, y, CAST(least(floor(score * 30), 29) AS INTEGER) AS bin,
  count(*) AS n_rows FROM preds WHERE split = 'val' GROUP BY ALL)
SELECT *, n_rows / (sum(n_rows) OVER (PARTITION BY {K}, y) * (1.0 / 30)) AS density FROM h""", ["density"]))
def q_score_histogram_by_class(spark, d):
    return ev.score_histogram_by_class(val(spark, d), KEYS)


def test_results_sql():
    """CTEs ending in ``test_results`` (every group at its validation threshold, on test)."""
    return thresholds_sql().replace("cum AS (", "cum AS (", 1) + f""", tsc AS (
  SELECT {K}, score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM preds WHERE split = 'test' GROUP BY {K}, score),
tcum AS (SELECT {K}, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER g AS n_pos, sum(neg) OVER g AS n_neg FROM tsc
         WINDOW w AS (PARTITION BY {K} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                g AS (PARTITION BY {K})),
tauc AS (SELECT {K}, CASE WHEN first(n_pos) > 0 AND first(n_neg) > 0 THEN
           sum(pos * (n_neg - fp + neg / 2.0)) / (CAST(first(n_pos) AS DOUBLE) * first(n_neg)) END AS auc
         FROM tcum GROUP BY {K}),
tcc AS (SELECT p.model, p.imputation, p.version, t.threshold,
          count_if(y = 1 AND score >= t.threshold) AS tp, count_if(y <> 1 AND score >= t.threshold) AS fp,
          count_if(y = 1 AND score < t.threshold) AS fn
        FROM preds p JOIN thresholds t USING ({K}) WHERE split = 'test' GROUP BY ALL),
test_results AS (SELECT {K}, threshold,
   round(CASE WHEN 2 * tp + fp + fn <> 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END, 4) AS f1,
   round(CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END, 4) AS precision,
   round(CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END, 4) AS recall,
   round(auc, 4) AS auc FROM tcc JOIN tauc USING ({K}))
"""


def thresholds_df(spark, d):
    return ev.best_threshold_pr(val(spark, d), KEYS)


def test_results_df(spark, d):
    return ev.evaluate_on_test(tb.preds(spark, d), thresholds_df(spark, d), KEYS)


@query("evaluate_on_test", test_results_sql() + f"SELECT {K}, threshold, f1, precision, recall, auc FROM test_results")
def q_evaluate_on_test(spark, d):
    return test_results_df(spark, d)


@query("apply_thresholds", thresholds_sql() + f""", ap AS (
  SELECT p.*, t.threshold, CAST(p.score >= t.threshold AS INTEGER) AS pred
  FROM preds p JOIN thresholds t USING ({K}) WHERE split = 'test')
SELECT {K}, pred, count(*) AS n_rows, count_if(y = 1) AS n_pos FROM ap GROUP BY ALL""")
def q_apply_thresholds(spark, d):
    p = ev.apply_thresholds(test(spark, d), thresholds_df(spark, d), KEYS)
    return p.groupBy(*KEYS, "pred").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("y") == 1).alias("n_pos"))


@query("prediction_distribution", R(WITH_PREDS + f""", c AS (SELECT model, CAST(score >= 0.5 AS INTEGER) AS label,
  count(*) AS n_rows FROM preds WHERE split = 'test' GROUP BY ALL)
SELECT model, label, n_rows, CAST(n_rows AS DOUBLE) * 100.0 / sum(n_rows) OVER (PARTITION BY model) AS pct FROM c""",
    ["pct"]))
def q_prediction_distribution(spark, d):
    return ev.prediction_distribution(ev.with_prediction(test(spark, d), 0.5), "pred", ["model"])


@query("agreement_rate", R(WITH_PREDS + """, a AS (SELECT row_id, CAST(score >= 0.5 AS INTEGER) AS pa FROM preds
  WHERE split = 'test' AND model = 'XGBoost'),
b AS (SELECT row_id, CAST(score >= 0.5 AS INTEGER) AS pb FROM preds WHERE split = 'test' AND model = 'GradBoost')
SELECT count(*) AS n_rows, avg(CAST(pa = pb AS DOUBLE)) AS agreement FROM a JOIN b USING (row_id)""", ["agreement"]))
def q_agreement_rate(spark, d):
    t = ev.with_prediction(test(spark, d), 0.5)
    return ev.agreement_rate(t.where(F.col("model") == "XGBoost"), t.where(F.col("model") == "GradBoost"))
