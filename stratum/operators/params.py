"""Fitted parameters as a small typed DataFrame.

Schema: ``step string, column string, param string, value double, value_str string``.
Fit operators return one; apply operators read it back (a few rows per column, so it is
collected and turned into literal Column expressions: apply stays a pure projection that
also works on streaming DataFrames).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PARAMS_SCHEMA = "step string, column string, param string, value double, value_str string"


def make_params(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows: (step, column, param, value, value_str)."""
    norm = [(s, c, p, None if v is None else float(v), vs) for s, c, p, v, vs in rows]
    return spark.createDataFrame(norm, PARAMS_SCHEMA)


def read_params(params: DataFrame, step: str | None = None) -> dict[str, dict[str, float | str | None]]:
    """{column: {param: value}} for one step.

    Only ``meta`` rows and ``method`` are texts; a number that is missing stays None."""
    df = params if step is None else params.where(params.step == step)
    out: dict[str, dict] = {}
    for r in df.collect():
        text = r["value"] is None and (r["step"] == "meta" or r["param"] == "method")
        out.setdefault(r["column"], {})[r["param"]] = r["value_str"] if text else r["value"]
    return out


def union_params(*ps: DataFrame) -> DataFrame:
    out = ps[0]
    for p in ps[1:]:
        out = out.unionByName(p)
    return out
