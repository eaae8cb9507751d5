"""Catalog entries: wide sparse binary tables in (row_id, feature) form (§2.4)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sparse as sx
from . import tables as tb
from .catalog import R, WITH_STUDY, query, sql_corr
from .tables import BINARY

WHOLE = [c for c in BINARY if c != "X4"]  # X4 has nulls, which the sparse form takes for zeros


@query("sparse_correlation_matrix", R(WITH_STUDY + "SELECT * FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {sql_corr(a, b)} AS corr FROM study" for i, a in enumerate(WHOLE) for b in WHOLE[i + 1:]) + ")", ["corr"]))
def q_sparse_correlation_matrix(spark, d):
    """The study's binaries as (row_id, feature) pairs; equal to the dense matrix."""
    s = tb.study(spark, d)
    return sx.sparse_correlation_matrix(sx.to_sparse(s, WHOLE), s.count(), WHOLE)


#: Features of a line: about 1,500 columns, nearly all zero.
_ONES = {"S": "l_suppkey % 400", "P": "l_partkey % 1000", "Q": "CAST(l_quantity AS BIGINT)", "M": "l_linestatus", "F": "l_returnflag", "N": "l_linenumber"}


@query("sparse_cooccurrence", R("""WITH ones AS (
""" + "\nUNION ALL\n".join(f"SELECT l_orderkey * 8 + l_linenumber AS row_id, concat('{k}', {e}) AS feature FROM lineitem" for k, e in _ONES.items()) + """),
n AS (SELECT feature, count(*) AS n FROM (SELECT DISTINCT row_id, feature FROM ones) GROUP BY feature),
t AS (SELECT count(*) AS n_rows FROM lineitem),
b AS (SELECT x.feature AS feature_a, y.feature AS feature_b, count(DISTINCT x.row_id) AS n_both FROM ones x JOIN ones y ON x.row_id = y.row_id AND x.feature < y.feature
      GROUP BY x.feature, y.feature)
SELECT feature_a, feature_b, n_both, CASE WHEN CAST(p.n AS DOUBLE) * (n_rows - p.n) * q.n * (n_rows - q.n) > 0 THEN
       (CAST(n_rows AS DOUBLE) * n_both - CAST(p.n AS DOUBLE) * q.n) / sqrt(CAST(p.n AS DOUBLE) * (n_rows - p.n) * q.n * (n_rows - q.n)) END AS corr
FROM b JOIN n p ON p.feature = feature_a JOIN n q ON q.feature = feature_b, t""", ["corr"]))
def q_sparse_cooccurrence(spark, d):
    """All pairs of one-hot features that occur together, with counts and phi, in one pass."""
    li = tb.read(spark, d, "lineitem")
    ones = li.select(F.expr("l_orderkey * 8 + l_linenumber").alias("row_id"),
                     F.explode(F.array(*[F.expr(f"concat('{k}', {e})") for k, e in _ONES.items()])).alias("feature"))
    return sx.phi_pairs(sx.cooccurrence(ones), li.count())


@query("sparse_presence_rates", R(WITH_STUDY + "SELECT * FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} = 1) AS BIGINT) AS n_ones, CAST(count_if({c} = 1) AS DOUBLE) * 100.0 / count(*) AS presence_pct FROM study" for c in BINARY)
    + ") WHERE n_ones > 0", ["presence_pct"]))
def q_sparse_presence_rates(spark, d):
    s = tb.study(spark, d)
    return sx.sparse_presence_rates(sx.to_sparse(s, BINARY), s.count())
