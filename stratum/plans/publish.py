"""Publishing predictions: positions, length reconciliation, label files and their checks."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalar import LABEL_CODES, qcol
from ..operators.running import running_totals


def with_position(df: DataFrame, order: str, out: str = "position") -> DataFrame:
    """0-based position in ``order`` (a running count: a window when small, range-partitioned
    blocks with offsets when large – never one task for a large table)."""
    r = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), [], order, ["_one"],
                       descending=False)
    return r.withColumn(out, F.col("cum__one") - 1).drop("_one", "cum__one")


def reconcile_length(df: DataFrame, n: int, mode: str = "error", order: str = "row_id") -> DataFrame:
    """Make a prediction set exactly ``n`` rows long.

    ``error`` (default): the lengths must agree. ``truncate``: the first n rows.
    ``cyclic``: row i of the output is row (i mod m) of the input – note that this repeats
    predictions instead of producing new ones."""
    m = df.count()
    if mode == "error":
        if m != n:
            raise ValueError(f"prediction count {m} differs from expected {n}")
        return with_position(df, order)
    pos = with_position(df, order)
    if mode == "truncate":
        return pos.where(F.col("position") < n)
    if mode == "cyclic":
        spark = df.sparkSession
        idx = spark.range(n).select(F.col("id").alias("out_position"), (F.col("id") % m).alias("position"))
        return idx.join(pos, "position").drop("position").withColumnRenamed("out_position", "position")
    raise ValueError(f"unknown mode {mode!r}")


def validate_submission(spark: SparkSession, path: str, n_expected: int,
                        labels=tuple(LABEL_CODES)) -> DataFrame:
    """Exact line count (blank lines ignored), labels within ``labels``, no header.

    Lines are ordered by (file name, scan order); the first bad line is found as the minimum
    of that key among bad lines and numbered by counting the lines before it."""
    t = (spark.read.text(path)
              .select(F.col("value"), F.input_file_name().alias("_f"), F.monotonically_increasing_id().alias("_m"))
              .where(F.trim("value") != ""))
    bad = ~F.trim("value").isin(list(labels))
    agg = t.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(bad).alias("n_bad"),
                F.min(F.when(bad, F.struct("_f", "_m", "value"))).alias("first")).first()
    first_line, first_value = None, None
    if agg["first"] is not None:
        f, mm, first_value = agg["first"]
        first_line = t.where((F.col("_f") < f) | ((F.col("_f") == f) & (F.col("_m") < mm))).count() + 1
    ok = agg["n_lines"] == n_expected and agg["n_bad"] == 0
    return spark.createDataFrame(
        [(agg["n_lines"], n_expected, agg["n_bad"], first_line, first_value, ok)],
        "n_lines bigint, n_expected bigint, n_bad bigint, first_bad_line bigint, first_bad_value string, valid boolean")
