"""Fit/apply cleaning: outlier removal and capping, median fill, scaling, binary checks."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.scalar import clip, qcol
from .params import make_params, read_params
from .quantiles import exact_quantiles


def fit_iqr_bounds(df: DataFrame, cols: list[str], k: float = 1.5, step: str = "cap") -> DataFrame:
    """lower/upper = q1 -/+ k*iqr per column (exact quartiles over non-null values)."""
    cols = [c for c in cols if c in df.columns]
    q = exact_quantiles(df, cols, [0.25, 0.75])
    rows = []
    for c in cols:
        q1, q3 = q[c]
        lo = None if q1 is None else q1 - k * (q3 - q1)
        hi = None if q1 is None else q3 + k * (q3 - q1)
        rows += [(step, c, "lower", lo, "iqr"), (step, c, "upper", hi, "iqr")]
    return make_params(df.sparkSession, rows)


def fit_zscore_bounds(df: DataFrame, cols: list[str], factor: float = 3.0, step: str = "cap") -> DataFrame:
    """lower/upper = mean -/+ factor * sample std."""
    cols = [c for c in cols if c in df.columns]
    row = df.agg(*[F.avg(qcol(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_samp(qcol(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    rows = []
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        ok = m is not None and s is not None
        rows += [(step, c, "lower", m - factor * s if ok else None, "zscore"),
                 (step, c, "upper", m + factor * s if ok else None, "zscore")]
    return make_params(df.sparkSession, rows)


def fit_caps(df: DataFrame, cols: list[str], method: str = "iqr", factor: float | None = None) -> DataFrame:
    if method == "iqr":
        return fit_iqr_bounds(df, cols, 1.5 if factor is None else factor)
    if method == "zscore":
        return fit_zscore_bounds(df, cols, 3.0 if factor is None else factor)
    raise ValueError(f"unknown capping method {method!r}")


def apply_caps(df: DataFrame, params: DataFrame, step: str = "cap") -> DataFrame:
    """Winsorise each fitted column into [lower, upper]; null stays null."""
    p = read_params(params, step)
    exprs = {c: clip(qcol(c), v.get("lower"), v.get("upper")) for c, v in p.items() if c in df.columns}
    return df.withColumns(exprs)


def cap_outliers(df: DataFrame, cols: list[str], method: str = "iqr", factor: float | None = None):
    """Fit on ``df`` and apply; returns (capped DataFrame, params)."""
    params = fit_caps(df, cols, method, factor)
    return apply_caps(df, params), params


def remove_outliers_iqr(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """Keep rows where every listed column lies inside its bounds (nulls are removed);
    bounds come from the full input, unknown columns are ignored."""
    p = read_params(fit_iqr_bounds(df, cols, k), "cap")
    conds = [qcol(c).between(F.lit(v["lower"]), F.lit(v["upper"])) for c, v in p.items()
             if v.get("lower") is not None]
    if not conds:
        return df
    return df.where(reduce(lambda a, b: a & b, conds))


def fit_median(df: DataFrame, cols: list[str] | None = None, step: str = "median") -> DataFrame:
    num = ("double", "float", "int", "bigint", "smallint", "tinyint")
    cols = cols or [c for c, t in df.dtypes if t in num]
    q = exact_quantiles(df, cols, [0.5])
    return make_params(df.sparkSession, [(step, c, "median", q[c][0], None) for c in cols])


def apply_median(df: DataFrame, params: DataFrame, step: str = "median") -> DataFrame:
    p = read_params(params, step)
    return df.withColumns({c: F.coalesce(qcol(c), F.lit(v["median"]).cast(dict(df.dtypes)[c]))
                           for c, v in p.items() if c in df.columns and v.get("median") is not None})


def fit_scale_std(df: DataFrame, cols: list[str], step: str = "scale") -> DataFrame:
    """Population std per column (0 -> 1); scaling divides without centring (zeros stay 0)."""
    row = df.agg(*[F.stddev_pop(qcol(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    rows = []
    for i, c in enumerate(cols):
        s = row[f"s{i}"]
        rows.append((step, c, "std", 1.0 if (s is None or s == 0) else s, None))
    return make_params(df.sparkSession, rows)


def apply_scale_std(df: DataFrame, params: DataFrame, step: str = "scale") -> DataFrame:
    p = read_params(params, step)
    return df.withColumns({c: qcol(c).cast("double") / F.lit(v["std"]) for c, v in p.items() if c in df.columns})


def check_binary_then_int(df: DataFrame, col: str) -> DataFrame:
    """If the non-null values are within {0, 1}: fill nulls with the median, cast to int."""
    x = qcol(col)
    if df.where(x.isNotNull() & ~x.isin(0, 1)).limit(1).count() > 0:
        return df
    med = exact_quantiles(df, [col], [0.5])[col][0]
    med = 0.0 if med is None else med
    return df.withColumn(col, F.coalesce(x, F.lit(med)).cast("int"))


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)
