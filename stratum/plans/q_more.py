"""Catalog entries: header rules, structure peek, result documents, correlation study,
stacking threshold re-optimisation."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev, profile as pf
from ..session import cut_lineage, scratch_path
from ..sources import coerce as co, delimited as dl, sinks as sk
from . import tables as tb, ensembles as en
from .catalog import query, R, WITH_STUDY, WITH_PREDS, CONTINUOUS, BINARY, FEATURES, K, sql_corr, union_per_column
from .q_evaluate import _grid_values_sql, _metrics_sql
from .q_profile import MATRIX_SQL

MESSY = [' "row_id" ', "X1", "  X2   value ", "X1.1", "y"]


@query("clean_column_names", R(WITH_STUDY + 'SELECT row_id, X1, X2 AS "X2 value", X3 AS "X1.1", y FROM study',
                               ["X1", "X2 value", "X1.1"]))
def q_clean_column_names(spark, d):
    s = tb.study(spark, d).select("row_id", "X1", "X2", "X3", "y").toDF(*MESSY)
    return dl.clean_column_names_df(s)


@query("drop_duplicate_columns", R(WITH_STUDY + 'SELECT row_id, X1, X2 AS "X2 value", y FROM study', ["X1", "X2 value"]))
def q_drop_duplicate_columns(spark, d):
    s = tb.study(spark, d).select("row_id", "X1", "X2", "X3", "y").toDF(*MESSY)
    return dl.drop_duplicate_columns_df(dl.clean_column_names_df(s))


@query("peek_structure", """SELECT * FROM (VALUES (0, 'row_id', true), (1, 'X1', true), (2, 'X2', true), (3, 'y', true))
  AS t(position, "column", has_target) WHERE (SELECT count(*) FROM lineitem) > 0""")
def q_peek_structure(spark, d):
    """study written as ';' CSV, then separator, columns and target presence from 5 rows."""
    path = scratch_path(spark, "peek")
    tb.study(spark, d).select("row_id", "X1", "X2", "y").write.mode("overwrite") \
        .option("header", True).option("sep", ";").csv(path)
    info = dl.peek_structure(spark, path, "y")
    return spark.createDataFrame([(i, c, info["has_target"]) for i, c in enumerate(info["columns"])],
                                 "position int, column string, has_target boolean")


@query("read_predictions_json")
def q_read_predictions_json(spark, d):
    """Mean-probability predictions written as JSON documents of about 400 rows each
    (per imputation/version and row block), then read back and exploded."""
    p = tb.preds(spark, d).where(F.col("split") == "test")
    mp = en.mean_probability(p, ["imputation", "version"])
    n = p.select("row_id").distinct().count()
    blk = F.pmod(F.col("row_id"), F.lit(max(1, n // 400)))  # row_id is an md5 prefix: blocks of about 400 rows
    docs = (mp.withColumn("_blk", blk)
              .groupBy("imputation", "version", "_blk")
              .agg(F.sort_array(F.collect_list(F.struct("row_id", "score"))).alias("_r"))
              .select(F.to_json(F.struct(
                  F.concat(F.lit("stacking_no_refit_"), F.lower("imputation"), F.lit("_"), F.lower("version")).alias("method"),
                  F.lit(0.5).alias("threshold"),
                  F.struct(F.transform("_r", lambda e: e["score"]).alias("test")).alias("predictions"))).alias("value")))
    path = scratch_path(spark, "stacking-docs")
    docs.write.mode("overwrite").text(path)
    return sk.read_predictions_json(spark, path, name_filter="", multi_line=False)


@query("correlation_study", R(WITH_STUDY + "SELECT * FROM (\n" + union_per_column(
    FEATURES, lambda c: f"SELECT 'target' AS kind, '{c}' AS col_a, 'y' AS col_b, {sql_corr(c, 'y')} AS corr FROM study")
    + f"\nUNION ALL SELECT 'pair', col_a, col_b, corr FROM ({MATRIX_SQL}) WHERE abs(corr) > 0.8)", ["corr"]))
def q_correlation_study(spark, d):
    """Continuous columns and binaries of each presence quartile: correlation with the target and |r| > 0.8 pairs."""
    study = pf.correlation_study(tb.study(spark, d), CONTINUOUS, BINARY, "y")
    target = study["ranking"].select(F.lit("target").alias("kind"), F.col("column").alias("col_a"), F.lit("y").alias("col_b"), "corr")
    return target.unionByName(study["pairs"].select(F.lit("pair").alias("kind"), "col_a", "col_b", "corr"))


@query("target_report", WITH_STUDY + """SELECT 'int' AS target_type, string_agg(coalesce(CAST(y AS VARCHAR), 'NULL'), ',' ORDER BY row_id) AS target_head
FROM (SELECT row_id, y FROM study ORDER BY row_id LIMIT 10)""")
def q_target_report(spark, d):
    return co.target_report(tb.study(spark, d), "y", "row_id")


@query("confusion_normalised", R(WITH_PREDS + f"""SELECT {K}, CAST(y AS INTEGER) AS actual, count(*) AS n_rows, avg(CAST(score < 0.5 AS DOUBLE)) AS predicted_0,
       avg(CAST(score >= 0.5 AS DOUBLE)) AS predicted_1 FROM preds WHERE split = 'test' GROUP BY {K}, y""", ["predicted_0", "predicted_1"]))
def q_confusion_normalised(spark, d):
    p = tb.preds(spark, d).where(F.col("split") == "test")
    return ev.normalised_confusion(ev.confusion_counts(ev.with_prediction(p, 0.5), tb.KEYS), tb.KEYS)


@query("frequent_patterns", R(WITH_STUDY + """, c AS (SELECT concat(CASE WHEN X1 IS NULL THEN '1' ELSE '0' END, CASE WHEN X2 IS NULL THEN '1' ELSE '0' END,
   CASE WHEN X3 IS NULL THEN '1' ELSE '0' END, CASE WHEN X4 IS NULL THEN '1' ELSE '0' END) AS pattern, count(*) AS n_rows FROM study GROUP BY 1),
t AS (SELECT CAST(sum(n_rows) AS BIGINT) AS n FROM c),
f AS (SELECT pattern, n_rows FROM c, t WHERE n_rows >= 0.05 * n),
a AS (SELECT * FROM f UNION ALL SELECT NULL, n - (SELECT CAST(sum(n_rows) AS BIGINT) FROM f) FROM t)
SELECT pattern, n_rows, CAST(n_rows AS DOUBLE) * 100.0 / n AS pct_rows FROM a, t WHERE n_rows > 0""", ["pct_rows"]))
def q_frequent_patterns(spark, d):
    """Null patterns of at least 5 % of the rows, exact, and the rest."""
    return pf.frequent_patterns(tb.study(spark, d), [*CONTINUOUS, "X4"], 0.05)


LIN = ev.DEFAULT_GRID


@query("reoptimise_stacking", R(WITH_PREDS + f""", mp AS (SELECT row_id, imputation, version, split, y, avg(score) AS score
  FROM preds GROUP BY row_id, imputation, version, split, y),
gr(grid_idx, threshold) AS ({_grid_values_sql(LIN)}),
gc AS (SELECT imputation, version, grid_idx, threshold, count_if(y = 1 AND score >= threshold) AS tp,
   count_if(y <> 1 AND score >= threshold) AS fp, count_if(y = 1 AND score < threshold) AS fn,
   count_if(y <> 1 AND score < threshold) AS tn FROM mp CROSS JOIN gr WHERE split = 'val' GROUP BY ALL),
gm AS ({_metrics_sql("SELECT * FROM gc")}),
b AS (SELECT * FROM gm QUALIFY row_number() OVER (PARTITION BY imputation, version ORDER BY f1 DESC, grid_idx) = 1),
th AS (SELECT imputation, version, CASE WHEN f1 > 0 THEN threshold ELSE 0.5 END AS threshold FROM b),
tc AS (SELECT imputation, version, th.threshold, count_if(y <> 1 AND score < th.threshold) AS tn,
   count_if(y <> 1 AND score >= th.threshold) AS fp, count_if(y = 1 AND score < th.threshold) AS fn,
   count_if(y = 1 AND score >= th.threshold) AS tp FROM mp JOIN th USING (imputation, version) WHERE split = 'test' GROUP BY ALL)
SELECT imputation, version, threshold, f1, precision, recall FROM ({_metrics_sql("SELECT * FROM tc")})""",
    ["threshold", "f1", "precision", "recall"]))
def q_reoptimise_stacking(spark, d):
    """Best 0.10..0.99 grid threshold of each stacked (mean-probability) variant on validation,
    then its test metrics."""
    keys = ["imputation", "version"]
    mp = cut_lineage(en.mean_probability(tb.preds(spark, d).where(F.col("split").isin("val", "test")), [*keys, "split"]))
    th = ev.best_threshold_grid(mp.where("split = 'val'"), keys).select(*keys, "threshold")
    test = mp.where("split = 'test'").join(th, keys)
    m = ev.metrics_from_counts(ev.confusion_counts(ev.with_prediction(test, F.col("threshold")), keys + ["threshold"]))
    return m.select(*keys, "threshold", "f1", "precision", "recall")
