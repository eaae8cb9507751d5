"""Catalog entries: profiling (§2.4), on the lineitem-derived study table."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as pf
from . import tables as tb
from .catalog import (query, R, WITH_STUDY, sql_corr, union_per_column, CONTINUOUS, BINARY, FEATURES)

ALL_STUDY = ["row_id"] + FEATURES + ["y"]


@query("class_distribution", R(WITH_STUDY + """
, c AS (SELECT y AS label, count(*) AS n_rows FROM study GROUP BY y)
SELECT label, n_rows, CAST(n_rows AS DOUBLE) * 100.0 / sum(n_rows) OVER () AS pct,
       CAST(max(n_rows) OVER () AS DOUBLE) / min(n_rows) OVER () AS imbalance FROM c""", ["pct", "imbalance"]))
def q_class_distribution(spark, d):
    return pf.class_distribution(tb.study(spark, d), "y")


@query("missing_profile", R(WITH_STUDY + "SELECT * FROM (\n" + union_per_column(ALL_STUDY, lambda c: f"""
SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS n_missing,
       CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / count(*) AS pct_missing FROM study""") + ") WHERE n_missing > 0",
    ["pct_missing"]))
def q_missing_profile(spark, d):
    return pf.missing_profile(tb.study(spark, d))


@query("missing_totals", R(WITH_STUDY + """
, t AS (SELECT CAST(count(*) * 12 AS BIGINT) AS n_cells,
        CAST(""" + " + ".join(f"(count(*) - count({c}))" for c in ALL_STUDY) + """ AS BIGINT) AS n_missing FROM study)
SELECT n_cells, n_missing, CAST(n_missing AS DOUBLE) * 100 / n_cells AS pct_missing FROM t""", ["pct_missing"]))
def q_missing_totals(spark, d):
    return pf.missing_totals(tb.study(spark, d))


@query("missing_per_row", WITH_STUDY + """
SELECT """ + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in ["X1", "X2", "X3", "X4"]) + """ AS n_missing,
       count(*) AS n_rows FROM study GROUP BY 1""")
def q_missing_per_row(spark, d):
    return pf.missing_per_row(tb.study(spark, d), ["X1", "X2", "X3", "X4"])


@query("missing_patterns", R(WITH_STUDY + """
, p AS (SELECT """ + " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in ["X1", "X2", "X3", "X4"]) + """ AS pattern,
        count(*) AS n_rows FROM study GROUP BY 1)
SELECT pattern, n_rows, CAST(n_rows AS DOUBLE) * 100.0 / sum(n_rows) OVER () AS pct_rows FROM p""", ["pct_rows"]))
def q_missing_patterns(spark, d):
    return pf.missing_patterns(tb.study(spark, d), ["X1", "X2", "X3", "X4"])


@query("nullity_correlation", R(WITH_STUDY + "SELECT * FROM (\n" + union_per_column(
    [(a, b) for i, a in enumerate(["X1", "X2", "X3", "X4"]) for b in ["X1", "X2", "X3", "X4"][i + 1:]],
    lambda p: f"SELECT '{p[0]}' AS col_a, '{p[1]}' AS col_b, "
              f"{sql_corr(f'CAST({p[0]} IS NULL AS INTEGER)', f'CAST({p[1]} IS NULL AS INTEGER)')} AS corr FROM study") + ")",
    ["corr"]))
def q_nullity_correlation(spark, d):
    return pf.nullity_correlation(tb.study(spark, d), ["X1", "X2", "X3", "X4"])


@query("missing_vs_target", R(WITH_STUDY + "SELECT * FROM (\n" + union_per_column(
    CONTINUOUS + ["X4"], lambda c: f"SELECT '{c}' AS \"column\", {sql_corr(f'CAST({c} IS NULL AS INTEGER)', 'y')} AS corr FROM study")
    + ")", ["corr"]))
def q_missing_vs_target(spark, d):
    return pf.missing_vs_target(tb.study(spark, d), CONTINUOUS + ["X4"], "y")


@query("presence_rates", R(WITH_STUDY + "SELECT * FROM (\n" + union_per_column(
    BINARY, lambda c: f"SELECT '{c}' AS \"column\", CAST(count_if({c} = 1) AS DOUBLE) * 100.0 / count(*) AS presence_pct FROM study")
    + ")", ["presence_pct"]))
def q_presence_rates(spark, d):
    return pf.presence_rates(tb.study(spark, d), BINARY)


@query("sparsity", R(WITH_STUDY + """
, t AS (SELECT CAST(""" + " + ".join(f"count_if({c} = 0)" for c in BINARY) + f""" AS BIGINT) AS n_zero,
        CAST(count(*) * {len(BINARY)} AS BIGINT) AS n_cells FROM study)
SELECT n_zero, n_cells, CAST(n_zero AS DOUBLE) * 100.0 / n_cells AS pct_zero FROM t""", ["pct_zero"]))
def q_sparsity(spark, d):
    return pf.sparsity(tb.study(spark, d), BINARY)


@query("describe_columns", R(WITH_STUDY + "SELECT * FROM (\n" + union_per_column(CONTINUOUS, lambda c: f"""
SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
       quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75,
       CAST(max({c}) AS DOUBLE) AS max FROM study""") + ")",
    ["mean", "std", "min", "q25", "q50", "q75", "max"]))
def q_describe_columns(spark, d):
    return pf.describe_columns(tb.study(spark, d), CONTINUOUS)


def _moments_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS n,
       avg(power({c} - mu, 3)) / power(avg(power({c} - mu, 2)), 1.5) AS skewness,
       avg(power({c} - mu, 4)) / power(avg(power({c} - mu, 2)), 2) - 3 AS kurtosis
  FROM study, (SELECT avg({c}) AS mu FROM study) m"""


@query("shape_moments", R(WITH_STUDY + """
, s AS (""" + union_per_column(CONTINUOUS, _moments_sql) + """)
SELECT "column", n, skewness, kurtosis,
       CASE WHEN n > 2 THEN sqrt(CAST(n AS DOUBLE) * (n - 1)) / (n - 2) * skewness END AS skewness_adj FROM s""",
    ["skewness", "kurtosis", "skewness_adj"]))
def q_shape_moments(spark, d):
    return pf.shape_moments(tb.study(spark, d), CONTINUOUS)


@query("normality_test", R(WITH_STUDY + """
, s AS (""" + union_per_column(CONTINUOUS, _moments_sql) + """),
j AS (SELECT "column", n, n / 6.0 * (power(skewness, 2) + power(kurtosis, 2) / 4.0) AS jb FROM s)
SELECT "column", n, jb, exp(-jb / 2.0) AS p_value, exp(-jb / 2.0) >= 0.01 AS normal FROM j""", ["jb", "p_value"]))
def q_normality_test(spark, d):
    return pf.normality_test(tb.study(spark, d), CONTINUOUS)


@query("iqr_bounds", R(WITH_STUDY + """
, q AS (""" + union_per_column(CONTINUOUS, lambda c: f"""SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS q1,
        quantile_cont({c}, 0.75) AS q3 FROM study""") + """),
b AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q),
o AS (""" + union_per_column(CONTINUOUS, lambda c: f"""SELECT '{c}' AS "column", count_if({c} < lower OR {c} > upper) AS n_outliers,
        count({c}) AS n_nonnull FROM study, (SELECT * FROM b WHERE "column" = '{c}') bb""") + """)
SELECT b."column", q1, q3, iqr, lower, upper, n_outliers,
       CASE WHEN n_nonnull > 0 THEN CAST(n_outliers AS DOUBLE) * 100 / n_nonnull ELSE 0.0 END AS pct_outliers
FROM b JOIN o ON b."column" = o."column\"""", ["q1", "q3", "iqr", "lower", "upper", "pct_outliers"]))
def q_iqr_bounds(spark, d):
    return pf.iqr_bounds(tb.study(spark, d), CONTINUOUS)


@query("target_correlation", R(WITH_STUDY + "SELECT * FROM (\n" + union_per_column(
    FEATURES, lambda c: f"SELECT '{c}' AS \"column\", {sql_corr(c, 'y')} AS corr FROM study") + ")", ["corr"]))
def q_target_correlation(spark, d):
    return pf.target_correlation(tb.study(spark, d), FEATURES, "y")


@query("top_correlated", R(WITH_STUDY + "SELECT * FROM (\n" + union_per_column(
    FEATURES, lambda c: f"SELECT '{c}' AS \"column\", {sql_corr(c, 'y')} AS corr FROM study") +
    ") WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, \"column\" LIMIT 5", ["corr"]))
def q_top_correlated(spark, d):
    return pf.top_correlated(pf.target_correlation(tb.study(spark, d), FEATURES, "y"), 5)


PAIRS = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]]
MATRIX_SQL = union_per_column(PAIRS, lambda p: f"SELECT '{p[0]}' AS col_a, '{p[1]}' AS col_b, {sql_corr(p[0], p[1])} AS corr FROM study")


@query("correlation_matrix", R(WITH_STUDY + "SELECT * FROM (\n" + MATRIX_SQL + ")", ["corr"]))
def q_correlation_matrix(spark, d):
    return pf.correlation_matrix(tb.study(spark, d), FEATURES)


@query("high_corr_pairs", R(WITH_STUDY + "SELECT * FROM (\n" + MATRIX_SQL + ") WHERE abs(corr) > 0.8", ["corr"]))
def q_high_corr_pairs(spark, d):
    return pf.high_corr_pairs(pf.correlation_matrix(tb.study(spark, d), FEATURES), 0.8)


def groups_sql(cols: list[str], threshold: float) -> str:
    """The greedy pass as a recursion over the columns in order."""
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {j} AS pos, {sql_corr(a, b)} AS r FROM study"
                               for j, b in enumerate(cols) for a in cols[:j])
    places = ", ".join(f"({j}, '{c}')" for j, c in enumerate(cols))
    return f"""WITH RECURSIVE {tb.STUDY_SQL}, e AS ({pairs}), p(pos, c) AS (VALUES {places}),
g AS (SELECT p.pos, c, list_sort(list_append(list(e.a), c)) AS members FROM p JOIN e ON e.pos = p.pos AND abs(r) > {threshold} GROUP BY p.pos, c),
st AS (SELECT -1 AS pos, CAST([] AS VARCHAR[]) AS visited, CAST(NULL AS VARCHAR[]) AS taken, 0 AS gid
  UNION ALL SELECT p.pos, CASE WHEN ok THEN list_concat(visited, members) ELSE visited END, CASE WHEN ok THEN members END, gid + CAST(ok AS INTEGER)
  FROM (SELECT p.pos, st.visited, st.gid, g.members, g.members IS NOT NULL AND NOT list_contains(st.visited, p.c) AS ok
        FROM st JOIN p ON p.pos = st.pos + 1 LEFT JOIN g ON g.pos = p.pos) AS p)
SELECT gid AS group_id, taken[i] AS "column", i = 1 AS keep FROM st, unnest(range(1, len(taken) + 1)) AS t(i) WHERE taken IS NOT NULL"""


@query("high_corr_groups", groups_sql(BINARY, 0.9))
def q_high_corr_groups(spark, d):
    return pf.high_corr_groups(tb.study(spark, d), BINARY, 0.9)


@query("histogram", R(WITH_STUDY + """
, mm AS (SELECT min(X1) AS lo, (max(X1) - min(X1)) / 30 AS w FROM study)
SELECT CAST(least(floor((X1 - lo) / w), 29) AS INTEGER) AS bin,
       lo + CAST(least(floor((X1 - lo) / w), 29) AS INTEGER) * w AS bin_start, count(*) AS n_rows
FROM study, mm WHERE X1 IS NOT NULL GROUP BY 1, 2""", ["bin_start"]))
def q_histogram(spark, d):
    return pf.histogram(tb.study(spark, d), "X1", 30)


@query("five_number", R(WITH_STUDY + """
, f AS (""" + union_per_column(["X1", "X2"], lambda c: f"""SELECT '{c}' AS "column", CAST(y AS VARCHAR) AS "group",
        CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
        quantile_cont({c}, 0.75) AS q3, CAST(max({c}) AS DOUBLE) AS max FROM study GROUP BY y""") + """)
SELECT *, greatest(min, q1 - 1.5 * (q3 - q1)) AS whisker_low, least(max, q3 + 1.5 * (q3 - q1)) AS whisker_high FROM f""",
    ["min", "q1", "median", "q3", "max", "whisker_low", "whisker_high"]))
def q_five_number(spark, d):
    return pf.five_number(tb.study(spark, d), ["X1", "X2"], by="y")


@query("eda_summary", R(WITH_STUDY + """
, a AS (SELECT count(*) AS n_rows, count_if(y = 1) AS n_pos, count_if(y = 0) AS n_neg,
        """ + " + ".join(f"count_if({c} = 0)" for c in BINARY) + """ AS n_zero,
        greatest(""" + ", ".join(f"abs({sql_corr(c, 'y')})" for c in FEATURES) + f""") AS max_abs_corr FROM study)
SELECT n_rows, {len(tb.FEATURES) + 2} AS n_columns,
       CAST(greatest(n_pos, n_neg) AS DOUBLE) / least(n_pos, n_neg) AS imbalance,
       CAST(n_zero AS DOUBLE) * 100.0 / (n_rows * {len(BINARY)}) AS sparsity_pct, max_abs_corr,
       {len(CONTINUOUS)} AS n_continuous, {len(BINARY)} AS n_binary FROM a""",
    ["imbalance", "sparsity_pct", "max_abs_corr"]))
def q_eda_summary(spark, d):
    return pf.eda_summary(tb.study(spark, d), "y", CONTINUOUS, BINARY)
