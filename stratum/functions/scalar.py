"""Scalar Column helpers used across operators."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the source project's conventions.
# Label codes: 'ad.' -> 1, 'noad.' -> 0.
LABEL_CODES = {"ad.": 1, "noad.": 0}
# Generalisation-gap status: gap > 0.05 -> 'over', gap > 0.03 -> 'slight', else 'good'.
GAP_LIMITS = (0.05, 0.03)
GAP_NAMES = ("over", "slight", "good")


def qcol(name: str) -> Column:
    """Column reference that tolerates spaces, dots and '^' in names."""
    return F.col("`" + name.replace("`", "``") + "`")


def clip(x: Column, lo=None, hi=None) -> Column:
    """Null-safe clip: null stays null (``greatest``/``least`` alone would skip nulls)."""
    out = x
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(x.isNotNull(), out)


def safe_div(n: Column, d: Column) -> Column:
    """n / d, and 0 when the denominator is 0 (metric convention)."""
    return F.when(d != 0, n.cast("double") / d.cast("double")).otherwise(F.lit(0.0))


def encode_label(x: Column, codes: dict | None = None) -> Column:
    codes = codes or LABEL_CODES
    expr = None
    for k, v in codes.items():
        expr = F.when(x == k, F.lit(v)) if expr is None else expr.when(x == k, F.lit(v))
    return expr.cast("int")


def decode_label(x: Column, codes: dict | None = None) -> Column:
    codes = codes or LABEL_CODES
    expr = None
    for k, v in codes.items():
        expr = F.when(x == v, F.lit(k)) if expr is None else expr.when(x == v, F.lit(k))
    return expr


def gap_status(gap: Column) -> Column:
    return (F.when(gap > GAP_LIMITS[0], GAP_NAMES[0])
             .when(gap > GAP_LIMITS[1], GAP_NAMES[1])
             .otherwise(GAP_NAMES[2]))


def prefer(*cols: Column) -> Column:
    """First non-null value (test value preferred over validation value, etc.)."""
    return F.coalesce(*cols)
