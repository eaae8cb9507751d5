"""Projections, label codes, row identity and column kinds (§2.2)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.scalar import decode_label as _dec, encode_label as _enc, qcol
from ..session import cut_lineage

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def rename_target(df: DataFrame, old: str = "outcome", new: str = "y") -> DataFrame:
    """``outcome`` <-> ``y``; error when neither name exists."""
    if old in df.columns:
        return df.withColumnRenamed(old, new)
    if new in df.columns:
        return df
    raise KeyError(f"target column not found: {old!r} / {new!r}")


def encode_label(df: DataFrame, col: str = "outcome", out: str = "y", codes: dict | None = None) -> DataFrame:
    return df.withColumn(out, _enc(qcol(col), codes))


def decode_label(df: DataFrame, col: str = "y", out: str = "outcome", codes: dict | None = None) -> DataFrame:
    return df.withColumn(out, _dec(qcol(col), codes))


def select_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """Listed columns that exist, in list order."""
    have = set(df.columns)
    return df.select(*[qcol(c) for c in cols if c in have])


def drop_listed(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Drop listed columns that exist; also return the listed names that were missing."""
    have = set(df.columns)
    return df.drop(*[c for c in cols if c in have]), [c for c in cols if c not in have]


def attach_row_id(df: DataFrame, id_col: str = "id", out: str = "row_id", contiguous: bool = True) -> DataFrame:
    """``id_col`` when present, else 0..n-1 in scan order, or ``monotonically_increasing_id``.

    Contiguous numbers: a row's place in its split (from a checkpoint, so that splits stay as they are) plus the rows of
    the splits before, one count per split."""
    if id_col in df.columns:
        return df.withColumn(out, qcol(id_col).cast("long"))
    if not contiguous:
        return df.withColumn(out, F.monotonically_increasing_id())
    marked = cut_lineage(df.withColumn("_place", F.monotonically_increasing_id())).withColumn("_split", F.shiftright("_place", 33))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    first = marked.groupBy("_split").agg(F.count(F.lit(1)).alias("_n")).select("_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    number = F.col("_first") + F.col("_place") - F.shiftleft("_split", 33)
    return marked.join(first, "_split").select(*[qcol(c) for c in df.columns if c != out], number.cast("long").alias(out))


def infer_column_kinds(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """numeric with > 2 distinct non-null values = continuous, <= 2 = binary, other = categorical.

    One HyperLogLog pass for every column; exact distinct counts only for numeric columns
    whose estimate is <= 4 (small sets, so bounded)."""
    cols = cols or df.columns
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    num = [c for c in cols if isinstance(types[c], NUMERIC)]
    est = df.agg(*[F.approx_count_distinct(qcol(c)).alias(f"e{i}") for i, c in enumerate(num)]).first() if num else {}
    small = [c for i, c in enumerate(num) if est[f"e{i}"] <= 4]
    exact = {}
    if small:
        row = df.agg(*[F.size(F.collect_set(qcol(c))).alias(f"x{i}") for i, c in enumerate(small)]).first()
        exact = {c: row[f"x{i}"] for i, c in enumerate(small)}
    rows = []
    for c in cols:
        if c not in num:
            rows.append((c, "categorical"))
        elif c in exact:
            rows.append((c, "binary" if exact[c] <= 2 else "continuous"))
        else:
            rows.append((c, "continuous"))
    return df.sparkSession.createDataFrame(rows, "column string, kind string")


def assert_shape(df: DataFrame, rows: int | None = None, cols: int | None = None) -> DataFrame:
    """One row: actual and expected dimensions and whether they match."""
    n = df.count()
    ok = (rows is None or n == rows) and (cols is None or len(df.columns) == cols)
    return df.sparkSession.createDataFrame(
        [(n, len(df.columns), rows, cols, ok)],
        "n_rows bigint, n_columns int, expected_rows bigint, expected_columns int, ok boolean")
