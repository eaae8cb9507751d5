"""Catalog entries: cleaning, transforms, splits (§2.9 fit/apply rows, §2.2 row operators)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as cl, transform as tf, splits as sp, profile as pf
from ..operators.params import read_params
from . import tables as tb
from .catalog import query, R, WITH_STUDY, union_per_column, CONTINUOUS, BINARY

H42 = "CAST(('0x' || substr(md5('42|' || CAST(row_id AS VARCHAR)), 1, 8)) AS BIGINT)"

BOUNDS_SQL = """, q AS (""" + union_per_column(CONTINUOUS, lambda c: f"""SELECT '{c}' AS col, quantile_cont({c}, 0.25) AS q1,
    quantile_cont({c}, 0.75) AS q3 FROM study""") + """),
bd AS (SELECT col, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
"""


def _bound(c, which):
    return f"(SELECT {which} FROM bd WHERE col = '{c}')"


@query("cap_outliers", R(WITH_STUDY + BOUNDS_SQL + """, capped AS (SELECT y, """ + ", ".join(
    f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {_bound(c, 'lo')}), {_bound(c, 'hi')}) END AS {c}, {c} AS {c}_raw"
    for c in CONTINUOUS) + """ FROM study)
SELECT y, count(*) AS n_rows, """ + ", ".join(f"avg({c}) AS avg_{c}" for c in CONTINUOUS) + ", " + ", ".join(
    f"count_if({c} <> {c}_raw) AS n_capped_{c}" for c in CONTINUOUS) + " FROM capped GROUP BY y",
    [f"avg_{c}" for c in CONTINUOUS]))
def q_cap_outliers(spark, d):
    """Flagship: fit IQR bounds on X1..X3 over the whole table, winsorise, summarise by class."""
    s = tb.study(spark, d).withColumns({f"{c}_raw": F.col(c) for c in CONTINUOUS})
    capped, _ = cl.cap_outliers(s, CONTINUOUS, "iqr")
    return capped.groupBy("y").agg(F.count(F.lit(1)).alias("n_rows"),
                                   *[F.avg(c).alias(f"avg_{c}") for c in CONTINUOUS],
                                   *[F.count_if(F.col(c) != F.col(f"{c}_raw")).alias(f"n_capped_{c}") for c in CONTINUOUS])


@query("cap_outliers_zscore", R(WITH_STUDY + """, z AS (""" + union_per_column(CONTINUOUS, lambda c: f"""SELECT '{c}' AS col,
    avg({c}) - 3.0 * stddev_samp({c}) AS lo, avg({c}) + 3.0 * stddev_samp({c}) AS hi FROM study""") + """)
SELECT row_id, """ + ", ".join(
    f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, (SELECT lo FROM z WHERE col = '{c}')), (SELECT hi FROM z WHERE col = '{c}')) END AS {c}"
    for c in CONTINUOUS) + " FROM study", CONTINUOUS))
def q_cap_outliers_zscore(spark, d):
    capped, _ = cl.cap_outliers(tb.study(spark, d).select("row_id", *CONTINUOUS), CONTINUOUS, "zscore", 3.0)
    return capped


@query("remove_outliers_iqr", WITH_STUDY + BOUNDS_SQL + """
SELECT y, count(*) AS n_rows FROM study WHERE """ + " AND ".join(
    f"{c} BETWEEN {_bound(c, 'lo')} AND {_bound(c, 'hi')}" for c in CONTINUOUS) + " GROUP BY y")
def q_remove_outliers_iqr(spark, d):
    return cl.remove_outliers_iqr(tb.study(spark, d), CONTINUOUS).groupBy("y").agg(F.count(F.lit(1)).alias("n_rows"))


MED_COLS = CONTINUOUS + ["X4"]


@query("fit_median", R(WITH_STUDY + "SELECT * FROM (" + union_per_column(
    MED_COLS, lambda c: f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.5) AS median FROM study") + ")", ["median"]))
def q_fit_median(spark, d):
    p = cl.fit_median(tb.study(spark, d), MED_COLS)
    return p.select("column", F.col("value").alias("median"))


@query("apply_median", R(WITH_STUDY + "SELECT row_id, " + ", ".join(
    f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM study)) AS {c}" for c in MED_COLS) + " FROM study", MED_COLS))
def q_apply_median(spark, d):
    s = tb.study(spark, d).select("row_id", *MED_COLS)
    return cl.apply_median(s, cl.fit_median(s, MED_COLS))


@query("check_binary_then_int", WITH_STUDY + """
SELECT row_id, CAST(trunc(coalesce(X4, (SELECT quantile_cont(X4, 0.5) FROM study))) AS INTEGER) AS X4 FROM study""")
def q_check_binary_then_int(spark, d):
    return cl.check_binary_then_int(tb.study(spark, d).select("row_id", "X4"), "X4")


@query("scale_std", R(WITH_STUDY + "SELECT row_id, " + ", ".join(
    f"CAST({c} AS DOUBLE) / (SELECT CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 ELSE stddev_pop({c}) END FROM study) AS {c}"
    for c in CONTINUOUS + ["X5", "X10"]) + " FROM study", CONTINUOUS + ["X5", "X10"]))
def q_scale_std(spark, d):
    cols = CONTINUOUS + ["X5", "X10"]
    s = tb.study(spark, d).select("row_id", *cols)
    return cl.apply_scale_std(s, cl.fit_scale_std(s, cols))


@query("complete_cases", WITH_STUDY + f"""SELECT y, count(*) AS n_rows FROM study
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in CONTINUOUS)} GROUP BY y""")
def q_complete_cases(spark, d):
    return cl.complete_cases(tb.study(spark, d), CONTINUOUS).groupBy("y").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- power transforms
def _dbl(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def _t_sql(x: str, method: str) -> str:
    if method == "yeo-johnson":
        return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN abs(lam) < 1e-12 THEN ln({x} + 1) ELSE (power({x} + 1, lam) - 1) / lam END) "
                f"ELSE (CASE WHEN abs(lam - 2) < 1e-12 THEN -ln(-{x} + 1) ELSE -(power(-{x} + 1, 2 - lam) - 1) / (2 - lam) END) END")
    return f"CASE WHEN abs(lam) < 1e-12 THEN ln({x}) ELSE (power({x}, lam) - 1) / lam END"


def _j_sql(x: str, method: str) -> str:
    return f"sign({x}) * ln(abs({x}) + 1)" if method == "yeo-johnson" else f"ln({x})"


def power_fit_sql(method: str, cols: list[str]) -> str:
    """CTE chain ending in ``pw(col, lam, shift, mean, std)``: grid rounds as in the operator."""
    parts = []
    if method == "box-cox":
        parts.append("sh AS (" + union_per_column(cols, lambda c: f"""SELECT '{c}' AS col,
            CASE WHEN min({c}) <= 0 THEN abs(min({c})) + {_dbl(tf.BOX_COX_SHIFT)} ELSE CAST(0.0 AS DOUBLE) END AS shift FROM study""") + ")")
    else:
        parts.append("sh AS (" + union_per_column(cols, lambda c: f"SELECT '{c}' AS col, CAST(0.0 AS DOUBLE) AS shift") + ")")
    parts.append("xs AS (" + union_per_column(cols, lambda c: f"""SELECT '{c}' AS col, CAST({c} AS DOUBLE) + (SELECT shift FROM sh WHERE col = '{c}') AS x
        FROM study WHERE {c} IS NOT NULL""") + ")")
    (s0, st0, n0), (_, st1, n1), (_, st2, n2) = tf.grid_rounds()
    g1 = ", ".join(f"({_dbl(s0 + i * st0)})" for i in range(n0))
    parts.append(f"c1(lam) AS (VALUES {g1})")
    prev = None
    for r, (step, n) in enumerate([(None, None), (st1, n1), (st2, n2)], start=1):
        if r == 1:
            cand = "cand1 AS (SELECT col, lam FROM (SELECT DISTINCT col FROM xs) cc CROSS JOIN c1)"
        else:
            cand = (f"cand{r} AS (SELECT col, lam + CAST(i - {n // 2} AS DOUBLE) * {_dbl(step)} AS lam "
                    f"FROM {prev} CROSS JOIN range({n}) AS t(i))")
        parts.append(cand)
        parts.append(f"""ll{r} AS (SELECT xs.col, lam, (-CAST(count(x) AS DOUBLE) / 2.0) * ln(var_pop({_t_sql('x', method)}))
            + (lam - 1) * sum({_j_sql('x', method)}) AS ll FROM xs JOIN cand{r} USING (col) GROUP BY xs.col, lam)""")
        parts.append(f"""best{r} AS (SELECT col, lam FROM ll{r} WHERE ll IS NOT NULL AND NOT isnan(ll)
            QUALIFY row_number() OVER (PARTITION BY col ORDER BY ll DESC, lam ASC) = 1)""")
        prev = f"best{r}"
    parts.append(f"""pw AS (SELECT xs.col, lam, (SELECT shift FROM sh WHERE sh.col = xs.col) AS shift,
        avg({_t_sql('x', method)}) AS mean,
        CASE WHEN stddev_pop({_t_sql('x', method)}) = 0 THEN 1.0 ELSE stddev_pop({_t_sql('x', method)}) END AS std
        FROM xs JOIN best3 USING (col) GROUP BY xs.col, lam)""")
    return ",\n".join(parts)


def _params_wide(p):
    rows = p.where(F.col("param").isin("lambda", "shift", "mean", "std")).groupBy("column").pivot(
        "param", ["lambda", "shift", "mean", "std"]).agg(F.first("value"))
    return rows.select("column", "lambda", "shift", "mean", "std")


YJ_COLS = CONTINUOUS
BC_COLS = CONTINUOUS


@query("yeo_johnson", R(WITH_STUDY + ", " + power_fit_sql("yeo-johnson", YJ_COLS) +
    '\nSELECT col AS "column", lam AS "lambda", shift, mean, std FROM pw', ["lambda", "shift", "mean", "std"]))
def q_yeo_johnson(spark, d):
    return _params_wide(tf.fit_power(tb.study(spark, d), YJ_COLS, "yeo-johnson"))


@query("box_cox", R(WITH_STUDY + ", " + power_fit_sql("box-cox", BC_COLS) +
    '\nSELECT col AS "column", lam AS "lambda", shift, mean, std FROM pw', ["lambda", "shift", "mean", "std"]))
def q_box_cox(spark, d):
    return _params_wide(tf.fit_power(tb.study(spark, d), BC_COLS, "box-cox"))


def choose_sql(cols: list[str]) -> str:
    """Both fits, the transformed values, and the skewness of each (standardising does not change it)."""
    skew = lambda t: f"(SELECT col, avg(power(v - m, 3)) / power(avg(power(v - m, 2)), 1.5) AS s FROM (SELECT col, v, avg(v) OVER (PARTITION BY col) AS m FROM {t}) GROUP BY col)"
    return f""", yj AS (WITH {power_fit_sql('yeo-johnson', cols)} SELECT * FROM pw),
bc AS (WITH {power_fit_sql('box-cox', cols)} SELECT * FROM pw),
raw AS ({union_per_column(cols, lambda c: f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM study WHERE {c} IS NOT NULL")}),
vy AS (SELECT col, {_t_sql('x', 'yeo-johnson')} AS v FROM (SELECT col, v AS x, lam FROM raw JOIN yj USING (col))),
vb AS (SELECT col, {_t_sql('x', 'box-cox')} AS v FROM (SELECT col, v + shift AS x, lam FROM raw JOIN bc USING (col)))
SELECT a.col AS "column", CASE WHEN abs(y.s) <= abs(b.s) THEN 'yeo-johnson' ELSE 'box-cox' END AS method,
  a.s AS skew_before, y.s AS skew_yeo_johnson, b.s AS skew_box_cox FROM {skew('raw')} a JOIN {skew('vy')} y USING (col) JOIN {skew('vb')} b USING (col)"""


@query("choose_transform", R(WITH_STUDY + choose_sql(CONTINUOUS), ["skew_before", "skew_yeo_johnson", "skew_box_cox"]))
def q_choose_transform(spark, d):
    """Both transforms fitted and applied, smaller |skew| wins."""
    return tf.choose_transform(tb.study(spark, d), CONTINUOUS)


# ---------------------------------------------------------------- splits
def _split_sql(test=0.2, val=0.2) -> str:
    return f""", hh AS (SELECT y, row_id, {H42} AS h FROM study),
rk AS (SELECT y, row_id, row_number() OVER (PARTITION BY y ORDER BY h, row_id) - 1 AS rk FROM hh),
cnt AS (SELECT y, count(*) AS n FROM study GROUP BY y),
tot AS (SELECT sum(n) AS n_all, CAST(ceil({_dbl(test)} * sum(n)) AS BIGINT) AS n_test FROM cnt),
ta AS (SELECT y, n, CAST(n_test * n AS DOUBLE) / n_all AS cont, floor(CAST(n_test * n AS DOUBLE) / n_all) AS fl, n_test FROM cnt, tot),
tb1 AS (SELECT y, n, CAST(fl AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY cont - fl DESC, y ASC)
          <= (SELECT max(n_test) - sum(fl) FROM ta) THEN 1 ELSE 0 END AS t FROM ta),
vt AS (SELECT CAST(ceil({_dbl(val)} / (1.0 - {_dbl(test)}) * (n_all - n_test)) AS BIGINT) AS n_val,
       n_all - n_test AS n_rest FROM tot),
va AS (SELECT y, t, n - t AS rest, CAST(n_val * (n - t) AS DOUBLE) / n_rest AS cont,
       floor(CAST(n_val * (n - t) AS DOUBLE) / n_rest) AS fl, n_val FROM tb1, vt),
alloc AS (SELECT y, t, CAST(fl AS BIGINT) + CASE WHEN row_number() OVER (ORDER BY cont - fl DESC, y ASC)
          <= (SELECT max(n_val) - sum(fl) FROM va) THEN 1 ELSE 0 END AS v FROM va),
splitted AS (SELECT rk.*, CASE WHEN rk < t THEN 'test' WHEN rk < t + v THEN 'val' ELSE 'train' END AS split
             FROM rk JOIN alloc USING (y))
"""


@query("stratified_split", WITH_STUDY + _split_sql() + "SELECT split, y, count(*) AS n_rows FROM splitted GROUP BY ALL")
def q_stratified_split(spark, d):
    s = sp.stratified_split(tb.study(spark, d).select("row_id", "y"), "y")
    return s.groupBy("split", "y").agg(F.count(F.lit(1)).alias("n_rows"))


@query("split_summary", R(WITH_STUDY + _split_sql() +
    "SELECT split, count(*) AS n_rows, avg(y) AS pos_share FROM splitted GROUP BY split", ["pos_share"]))
def q_split_summary(spark, d):
    s = sp.stratified_split(tb.study(spark, d).select("row_id", "y"), "y")
    return pf.split_summary(s, "y", keys=("split",))


@query("stratified_folds", WITH_STUDY + f""", hh AS (SELECT y, row_id, {H42} AS h FROM study),
rk AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY h, row_id) - 1 AS rk FROM hh)
SELECT CAST(rk % 5 AS INTEGER) AS fold, y, count(*) AS n_rows FROM rk GROUP BY ALL""")
def q_stratified_folds(spark, d):
    f = sp.stratified_folds(tb.study(spark, d).select("row_id", "y"), "y", 5)
    return f.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n_rows"))


@query("sample_rows", WITH_STUDY + f"SELECT row_id, y FROM study ORDER BY {H42}, row_id LIMIT 1000")
def q_sample_rows(spark, d):
    return sp.sample_rows(tb.study(spark, d).select("row_id", "y"), 1000)


@query("stratified_column_sample", R(WITH_STUDY + ", r AS (SELECT * FROM (" + union_per_column(
    BINARY, lambda c: f"SELECT '{c}' AS \"column\", round(CAST(count_if({c} = 1) AS DOUBLE) * 100.0 / count(*), 6) AS presence_pct FROM study")
    + """)), qq AS (SELECT quantile_cont(presence_pct, 0.25) AS a, quantile_cont(presence_pct, 0.5) AS b,
        quantile_cont(presence_pct, 0.75) AS c FROM r),
rq AS (SELECT r.*, CASE WHEN presence_pct <= a THEN 1 WHEN presence_pct <= b THEN 2 WHEN presence_pct <= c THEN 3 ELSE 4 END AS quartile
       FROM r, qq)
SELECT "column", presence_pct, quartile FROM rq
QUALIFY row_number() OVER (PARTITION BY quartile ORDER BY CAST(('0x' || substr(md5('42|' || "column"), 1, 8)) AS BIGINT), "column") <= 10""",
    ["presence_pct"]))
def q_stratified_column_sample(spark, d):
    rates = pf.presence_rates(tb.study(spark, d), BINARY)
    return sp.stratified_column_sample(rates)
