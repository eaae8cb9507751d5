"""Query catalog: one entry per operator, each a Spark plan over the driver tables plus,
where SQL can express it, the equivalent DuckDB SQL used as the correctness oracle.

All double outputs are rounded to 6 decimals on both sides so the comparison is exact.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import tables as tb
from .tables import KEYS, CONTINUOUS, BINARY, FEATURES, STUDY_SQL, PREDS_SQL, with_sql

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _bigint_counts(sql: str) -> str:
    """Wrap every ``count_if(...)`` in ``CAST(... AS BIGINT)`` (DuckDB returns HUGEINT)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


def query(name: str, sql: str | None = None):
    if sql:
        sql = _bigint_counts(sql)

    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            return rounded(_fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def R(select_sql: str, doubles: list[str]) -> str:
    """Wrap a SELECT so that the listed double columns are rounded to 6 decimals."""
    rep = ", ".join(f'round("{c}", 6) AS "{c}"' for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({select_sql}) AS _q" if doubles else select_sql


K = ", ".join(KEYS)
WITH_STUDY = with_sql(STUDY_SQL)
WITH_PREDS = with_sql(PREDS_SQL)


def sql_corr(x: str, y: str) -> str:
    xm = f"(CASE WHEN ({x}) IS NOT NULL AND ({y}) IS NOT NULL THEN CAST({x} AS DOUBLE) END)"
    ym = f"(CASE WHEN ({x}) IS NOT NULL AND ({y}) IS NOT NULL THEN CAST({y} AS DOUBLE) END)"
    den = f"(stddev_pop({xm}) * stddev_pop({ym}))"
    return f"(CASE WHEN {den} > 0 THEN covar_pop({xm}, {ym}) / {den} END)"


def union_per_column(cols: list[str], body: Callable[[str], str]) -> str:
    return "\nUNION ALL\n".join(body(c) for c in cols)


# Import the query modules so their @query decorators populate REGISTRY.
from . import q_profile, q_evaluate, q_clean, q_results, q_sources, q_ensembles, q_impute, q_features, q_models, q_more, q_sparse, q_exact  # noqa: E402,F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1]}
