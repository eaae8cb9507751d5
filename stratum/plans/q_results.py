"""Catalog entries: result-table operators (§2.3, §2.5-2.7) on the validation thresholds
and test results derived from the prediction table."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import results as rs
from . import tables as tb
from .catalog import query, R, K, KEYS, WITH_STUDY
from .q_evaluate import thresholds_sql, test_results_sql, thresholds_df, test_results_df

T_COLS = "model, imputation, version, threshold, f1, precision, recall"
GAP_SQL = """CASE WHEN gap > 0.05 THEN 'over' WHEN gap > 0.03 THEN 'slight' ELSE 'good' END"""


@query("rank_models", thresholds_sql() + f"""SELECT {T_COLS},
  CAST(row_number() OVER (ORDER BY f1 DESC, model, imputation, version) AS INTEGER) AS ranking FROM thresholds""")
def q_rank_models(spark, d):
    return rs.rank_models(thresholds_df(spark, d))


@query("best_per_group", thresholds_sql() + f"""SELECT {T_COLS} FROM thresholds
QUALIFY row_number() OVER (PARTITION BY imputation, version ORDER BY f1 DESC, model) = 1""")
def q_best_per_group(spark, d):
    return rs.best_per_group(thresholds_df(spark, d))


@query("top_n_models", thresholds_sql() + f"SELECT {T_COLS} FROM thresholds ORDER BY f1 DESC, model, imputation, version LIMIT 5")
def q_top_n_models(spark, d):
    return rs.top_n_models(thresholds_df(spark, d), 5)


@query("select_champion", thresholds_sql() + """SELECT lower(model) AS model, lower(imputation) AS imputation,
  lower(version) AS version, coalesce(threshold, 0.5) AS threshold, f1, precision, recall
  FROM thresholds ORDER BY f1 DESC, model, imputation, version LIMIT 1""")
def q_select_champion(spark, d):
    return rs.select_champion(thresholds_df(spark, d))


@query("select_champions", thresholds_sql() + f"""SELECT {T_COLS} FROM thresholds WHERE version = 'FULL' AND f1 >= 0.7
  ORDER BY f1 DESC, model, imputation, version LIMIT 4""")
def q_select_champions(spark, d):
    return rs.select_champions(thresholds_df(spark, d), "FULL", 0.7, 4)


@query("filter_results", thresholds_sql() + f"SELECT {T_COLS} FROM thresholds WHERE version = 'FULL' AND f1 >= 0.6")
def q_filter_results(spark, d):
    return rs.filter_results(thresholds_df(spark, d), min_metric=0.6, version="FULL")


@query("compare_variants", R(thresholds_sql() + """, p AS (SELECT model, version,
  max(CASE WHEN imputation = 'KNN' THEN f1 END) AS f1_knn, max(CASE WHEN imputation = 'MICE' THEN f1 END) AS f1_mice
  FROM thresholds GROUP BY model, version)
SELECT *, f1_knn - f1_mice AS difference,
  CASE WHEN f1_knn > f1_mice THEN 'KNN' WHEN f1_mice > f1_knn THEN 'MICE' WHEN f1_knn = f1_mice THEN 'tie' END AS winner FROM p""",
    ["difference"]))
def q_compare_variants(spark, d):
    return rs.compare_variants(thresholds_df(spark, d))


VT_SQL = f""", vt AS (SELECT {K}, v.f1 AS f1_val, t.f1 AS f1_test, v.f1 - t.f1 AS gap
  FROM thresholds v JOIN test_results t USING ({K}))
"""


@query("validation_test_gap", R(test_results_sql() + VT_SQL + f"SELECT *, {GAP_SQL} AS status FROM vt", ["gap"]))
def q_validation_test_gap(spark, d):
    return rs.validation_test_gap(thresholds_df(spark, d), test_results_df(spark, d))


@query("union_results", test_results_sql() + f"""SELECT {T_COLS}, CAST(NULL AS DOUBLE) AS auc, 'validation' AS source FROM thresholds
UNION ALL SELECT {T_COLS}, auc, 'test' AS source FROM test_results""")
def q_union_results(spark, d):
    return rs.union_results((thresholds_df(spark, d), "validation"), (test_results_df(spark, d), "test"))


@query("results_summary", R(test_results_sql() + VT_SQL + """, j AS (SELECT vt.*, t.threshold FROM vt JOIN thresholds t USING (model, imputation, version))
SELECT count(*) AS n_models, max(f1_val) AS max_f1, avg(f1_val) AS mean_f1, max(f1_val) - min(f1_val) AS spread_f1,
  avg(threshold) AS mean_threshold, count_if(abs(gap) <= 0.03) AS n_small_gap FROM j""",
    ["max_f1", "mean_f1", "spread_f1", "mean_threshold"]))
def q_results_summary(spark, d):
    th = thresholds_df(spark, d)
    vt = rs.validation_test_gap(th, test_results_df(spark, d)).join(th.select(*KEYS, "threshold"), KEYS)
    return rs.results_summary(vt.withColumnRenamed("f1_val", "f1"))


@query("export_metrics", test_results_sql() + f"""SELECT {K}, metric, value FROM test_results
UNPIVOT (value FOR metric IN (f1, precision, recall, auc))""")
def q_export_metrics(spark, d):
    return rs.export_metrics(test_results_df(spark, d), KEYS, ["f1", "precision", "recall", "auc"])


@query("comparison_table", test_results_sql() + f"""SELECT {K}, coalesce(t.f1, v.f1) AS f1, coalesce(t.precision, v.precision) AS precision,
  coalesce(t.recall, v.recall) AS recall, CASE WHEN t.f1 IS NOT NULL THEN 'test' ELSE 'validation' END AS origin
  FROM thresholds v FULL JOIN test_results t USING ({K})""")
def q_comparison_table(spark, d):
    return rs.comparison_table(thresholds_df(spark, d), test_results_df(spark, d))


@query("models_vs_ensembles", R(test_results_sql() + f""", mp AS (SELECT row_id, imputation, version, y, avg(score) AS score
  FROM preds WHERE split = 'test' GROUP BY row_id, imputation, version, y),
mc AS (SELECT imputation, version, count_if(y = 1 AND score >= 0.5) AS tp, count_if(y <> 1 AND score >= 0.5) AS fp,
  count_if(y = 1 AND score < 0.5) AS fn FROM mp GROUP BY imputation, version)
SELECT {K}, f1, 'individual' AS type FROM test_results
UNION ALL
SELECT 'MeanProbability' AS model, imputation, version,
  round(CASE WHEN 2 * tp + fp + fn <> 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END, 4) AS f1,
  'ensemble' AS type FROM mc""", ["f1"]))
def q_models_vs_ensembles(spark, d):
    from ..operators import evaluate as ev
    from . import ensembles as en
    mp = en.mean_probability(tb.preds(spark, d).where(F.col("split") == "test"), ["imputation", "version"])
    m = ev.metrics_from_counts(ev.confusion_counts(ev.with_prediction(mp, 0.5), ["imputation", "version"]))
    ens = m.select(F.lit("MeanProbability").alias("model"), "imputation", "version",
                   F.round("f1", 4).alias("f1"))
    ind = test_results_df(spark, d).select(*KEYS, "f1")
    return rs.union_results((ind, "individual"), (ens, "ensemble"), tag_col="type", sort=None)


@query("align_by_row_id", R(WITH_STUDY.rstrip() + ", " + test_results_sql()[len("WITH "):] + """
SELECT p.row_id, p.score, s.X1, s.y FROM preds p JOIN study s USING (row_id)
WHERE p.split = 'test' AND p.model = 'XGBoost'""", ["score", "X1"]))
def q_align_by_row_id(spark, d):
    p = tb.preds(spark, d).where((F.col("split") == "test") & (F.col("model") == "XGBoost")).select("row_id", "score")
    return p.join(tb.study(spark, d).select("row_id", "X1", "y"), "row_id")
