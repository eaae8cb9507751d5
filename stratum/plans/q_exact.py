"""Catalog entries: neighbour searches over ``part`` with brute-force SQL (§2.9).

The same operators run over ``lineitem`` in ``q_impute``; that table's pairs are too many for SQL. Here every
row of ``part`` takes part: three features with nulls and a target of about a seventh ones.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import clean as cl, knn, mice, profile as pf, resample
from . import tables as tb
from .catalog import query, R, union_per_column

COLS = ["P1", "P2", "P3"]
K = 7
K_VALUES = range(3, 20, 2)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return tb.read(spark, sf_dir, "part").select(
        c("p_partkey").alias("row_id"),
        F.when(c("p_partkey") % 5 != 0, c("p_size").cast("double")).alias("P1"),
        F.when(c("p_partkey") % 7 != 1, c("p_retailprice") / F.lit(25.0)).alias("P2"),
        F.when(c("p_partkey") % 11 != 2, F.length("p_name").cast("double")).alias("P3"),
        ((c("p_size") * 3 + c("p_partkey")) % 7 == 0).cast("int").alias("y"))


PARTS_SQL = """study AS (SELECT p_partkey AS row_id,
  CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS DOUBLE) END AS P1,
  CASE WHEN p_partkey % 7 <> 1 THEN p_retailprice / CAST(25.0 AS DOUBLE) END AS P2,
  CASE WHEN p_partkey % 11 <> 2 THEN CAST(length(p_name) AS DOUBLE) END AS P3,
  CAST((p_size * 3 + p_partkey) % 7 = 0 AS INTEGER) AS y FROM part)"""


def _distance_sql(a: str, b: str, cols: list[str], p: int) -> str:
    """NaN-aware distance of aliases ``a`` and ``b`` over the columns that both have, scaled to ``p`` columns."""
    n = " + ".join(f"CAST({a}.{c} IS NOT NULL AND {b}.{c} IS NOT NULL AS INTEGER)" for c in cols)
    total = " + ".join(f"coalesce(({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c}), 0.0)" for c in cols)
    return f"CASE WHEN ({n}) > 0 THEN sqrt((CAST({p} AS DOUBLE) / ({n})) * ({total})) END"


def _knn_sql(k: int, cols: list[str] = COLS) -> str:
    """CTEs up to ``filled``: all pairs of a receiver and a donor, ranked per missing column; columns beside ``cols`` get medians."""
    far = _distance_sql("r", "d", cols, len(cols))
    near = union_per_column(cols, lambda c: f"""SELECT row_id, '{c}' AS col, avg(value) AS est FROM (
      SELECT r.row_id, d.{c} AS value, row_number() OVER (PARTITION BY r.row_id ORDER BY {far}, d.row_id) AS rk
      FROM study r JOIN study d ON r.{c} IS NULL AND d.{c} IS NOT NULL WHERE {far} IS NOT NULL) WHERE rk <= {k} GROUP BY row_id""")
    fill = {c: f"(SELECT est FROM near n WHERE n.row_id = s.row_id AND n.col = '{c}'), (SELECT avg({c}) FROM study)" for c in cols}
    fills = ", ".join(f"coalesce(s.{c}, {fill.get(c, f'(SELECT quantile_cont({c}, 0.5) FROM study)')}) AS {c}" for c in COLS)
    return f", near AS ({near}), filled AS (SELECT s.row_id, {fills}, s.y FROM study s)"


@query("impute_knn_parts", R(f"WITH {PARTS_SQL}{_knn_sql(K)} SELECT row_id, P1, P2, P3, y FROM filled", COLS))
def q_impute_knn_parts(spark, d):
    return knn.impute_knn(parts(spark, d), COLS, k=K)


@query("impute_with_fallback_parts", R(f"WITH {PARTS_SQL}{_knn_sql(K, COLS[:2])} SELECT row_id, P1, P2, P3, y, 'knn' AS method FROM filled", COLS))
def q_impute_with_fallback_parts(spark, d):
    """Two columns by their nearest donors, the third by its median."""
    out, tag = mice.impute_with_fallback(parts(spark, d), COLS, method="knn", strategy="mixed_mar_mcar", mcar_cols=COLS[2:], k=K)
    return out.withColumn("method", F.lit(tag))


@query("imputation_drift_parts", R(f"WITH {PARTS_SQL}{_knn_sql(K)}" + ", st AS (" + union_per_column(COLS, lambda c: f"""
  SELECT '{c}' AS "column", (SELECT avg({c}) FROM study) AS mean_before, (SELECT stddev_samp({c}) FROM study) AS std_before,
  avg({c}) AS mean_after, stddev_samp({c}) AS std_after FROM filled""") + """)
SELECT *, mean_after - mean_before AS mean_shift, std_after - std_before AS std_shift FROM st""",
    ["mean_before", "std_before", "mean_after", "std_after", "mean_shift", "std_shift"]))
def q_imputation_drift_parts(spark, d):
    before = parts(spark, d)
    return pf.imputation_drift(before, knn.impute_knn(before, COLS, k=K), COLS)


def _tune_sql() -> str:
    h = lambda t: f"CAST(('0x' || substr(md5('42|' || {t}), 1, 8)) AS BIGINT)"
    gone = lambda c: f"""{h(f"CAST(row_id AS VARCHAR) || '|{c}'")} / 4294967296.0 < CAST('0.2' AS DOUBLE)"""
    masked = ", ".join(f"CASE WHEN NOT ({gone(c)}) THEN {c} END AS {c}" for c in COLS)
    truth = ", ".join(f"{c} AS t_{c}" for c in COLS)
    found = union_per_column(COLS, lambda c: f"""SELECT r.row_id, '{c}' AS col, d.{c} AS value,
      row_number() OVER (PARTITION BY r.row_id ORDER BY {_distance_sql('r', 'd', COLS, 3)}, d.row_id) AS rk
      FROM masked r JOIN comp d ON r.fold <> d.fold WHERE r.{c} IS NULL AND {_distance_sql('r', 'd', COLS, 3)} IS NOT NULL""")
    hidden = union_per_column(COLS, lambda c: f"""SELECT row_id, fold, '{c}' AS col, t_{c} AS truth,
      (SELECT avg({c}) FROM comp d WHERE d.fold <> m.fold) AS mean FROM masked m WHERE {c} IS NULL""")
    ks = ", ".join(f"({k})" for k in K_VALUES)
    return f"""WITH {PARTS_SQL},
comp AS (SELECT row_id, P1, P2, P3, {h('CAST(row_id AS VARCHAR)')} % 5 AS fold FROM study WHERE P1 IS NOT NULL AND P2 IS NOT NULL AND P3 IS NOT NULL),
masked AS (SELECT row_id, fold, {masked}, {truth} FROM comp),
found AS ({found}), hidden AS ({hidden}), ks(k) AS (VALUES {ks}),
est AS (SELECT row_id, col, k, avg(value) AS est FROM found JOIN ks ON rk <= k GROUP BY ALL),
err AS (SELECT k, fold, sqrt(avg((coalesce(est, mean) - truth) * (coalesce(est, mean) - truth))) AS rmse
        FROM hidden CROSS JOIN ks LEFT JOIN est USING (row_id, col, k) GROUP BY k, fold),
res AS (SELECT k, avg(rmse) AS mean, stddev_pop(rmse) AS std FROM err GROUP BY k)
SELECT k, mean, std, row_number() OVER (ORDER BY mean, k) = 1 AS best FROM res"""


@query("tune_knn_k_parts", R(_tune_sql(), ["mean", "std"]))
def q_tune_knn_k_parts(spark, d):
    return knn.tune_knn_k(parts(spark, d), COLS, K_VALUES)


def _smote_sql(m: int, k: int) -> str:
    med = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM study)) AS {c}" for c in COLS)
    h = lambda t: f"CAST(('0x' || substr(md5({t}), 1, 8)) AS BIGINT)"
    near = lambda a, b, n: f"""SELECT q.row_id, d.row_id AS donor, d.y, row_number() OVER (PARTITION BY q.row_id ORDER BY {_distance_sql('q', 'd', COLS, 4)}, d.row_id) AS rk
      FROM {a} q JOIN {b} d ON q.row_id <> d.row_id QUALIFY rk <= {n}"""  # noqa: E731
    new = ", ".join(f"g.{c} + gap * (d.{c} - g.{c}) AS {c}" for c in COLS)
    return f"""WITH {PARTS_SQL},
tr AS (SELECT row_id, {med}, y FROM study),
mino AS (SELECT * FROM tr WHERE y = 1),
n1 AS ({near('mino', 'tr', m)}),
danger AS (SELECT mino.* FROM mino JOIN (SELECT row_id FROM n1 GROUP BY row_id HAVING count_if(y = 0) >= {m} / 2.0 AND count_if(y = 0) < {m}) USING (row_id)),
ranked AS (SELECT *, row_number() OVER (ORDER BY {h("'42|' || CAST(row_id AS VARCHAR)")}, row_id) - 1 AS di FROM danger),
n2 AS ({near('danger', 'mino', k)}),
found AS (SELECT row_id, count(*) AS nk FROM n2 GROUP BY row_id),
size AS (SELECT CAST(floor(CAST('0.8' AS DOUBLE) * count_if(y = 0)) AS BIGINT) - count_if(y = 1) AS n_new FROM tr),
js AS (SELECT i AS j, CAST(('0x' || substr(md5('42|' || CAST(i AS VARCHAR)), 1, 15)) AS BIGINT) AS h, {h("'42g|' || CAST(i AS VARCHAR)")} / 4294967296.0 AS gap
       FROM size, range(greatest(n_new, 0)) AS t(i)),
jd AS (SELECT j, gap, h % n AS di, CAST(floor(CAST(h AS DOUBLE) / n) AS BIGINT) AS hq FROM js, (SELECT count(*) AS n FROM danger) WHERE n > 0),
made AS (SELECT -(j + 1) AS row_id, {new}, 1 AS y, true AS synthetic
         FROM jd JOIN ranked g USING (di) JOIN found f ON f.row_id = g.row_id
         JOIN n2 ON n2.row_id = g.row_id AND n2.rk - 1 = hq % nk JOIN mino d ON d.row_id = n2.donor)
SELECT *, false AS synthetic FROM tr UNION ALL SELECT * FROM made"""


@query("borderline_smote_parts", R(_smote_sql(10, 5), COLS))
def q_borderline_smote_parts(spark, d):
    """All parts (nulls become medians), minority raised to 0.8 x majority."""
    s = parts(spark, d)
    s = cl.apply_median(s, cl.fit_median(s, COLS))
    return resample.borderline_smote(s, COLS, "y", ratio=0.8, m=10, k=5)
