"""Deterministic, engine-portable randomness.

``portable_hash(id, seed)`` = first 8 hex digits of ``md5('<seed>|<id>')`` read as an
unsigned 32-bit number. The same value is computed by any SQL engine with ``md5``, so
splits, folds, samples and masks are reproducible outside Spark. ``rand()`` is never used.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def portable_hash(col, seed: int | str = 42) -> Column:
    s = F.concat(F.lit(f"{seed}|"), _c(col).cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def uniform(col, seed: int | str = 42) -> Column:
    """Deterministic value in [0, 1) per key."""
    return portable_hash(col, seed) / F.lit(4294967296.0)


def row_key(*cols) -> Column:
    """60-bit id from a composite key (md5 of the '|'-joined parts, 15 hex digits)."""
    s = F.concat_ws("|", *[_c(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("bigint")
