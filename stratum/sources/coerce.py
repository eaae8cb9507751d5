"""Type coercion and source reports."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.scalar import qcol


def coerce_numeric(df: DataFrame, keep=("id",)) -> DataFrame:
    """Every column not in ``keep`` -> double; text that is not a number -> NULL; NaN -> NULL."""
    cols = []
    for c, t in df.dtypes:
        if c in keep:
            cols.append(qcol(c))
            continue
        v = qcol(c).try_cast("double") if t == "string" else qcol(c).cast("double")
        cols.append(F.when(~F.isnan(v), v).alias(c))
    return df.select(*cols)


def coercion_report(df: DataFrame, keep=("id",), limit: float = 0.9) -> DataFrame:
    """Columns that ended with some NULLs but less than ``limit`` of the rows."""
    cols = [c for c in df.columns if c not in keep]
    n = F.count(F.lit(1))
    row = df.agg(n.alias("n"), *[F.count_if(qcol(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_null"),
                        (F.col(f"m{i}") / F.col("n")).alias("share_null")) for i, c in enumerate(cols)]
    out = row.select(F.inline(F.array(*structs)))
    return out.where((F.col("n_null") > 0) & (F.col("share_null") < limit))


def source_report(df: DataFrame, target: str | None = None) -> DataFrame:
    """One row: rows, columns, type counts, missing cells; target non-null/null/%/distinct."""
    kinds = {"numeric": 0, "string": 0, "other": 0}
    for _, t in df.dtypes:
        if t in ("double", "float", "int", "bigint", "smallint", "tinyint") or t.startswith("decimal"):
            kinds["numeric"] += 1
        elif t == "string":
            kinds["string"] += 1
        else:
            kinds["other"] += 1
    miss = sum((F.count_if(qcol(c).isNull()) for c in df.columns), F.lit(0)).cast("bigint")
    aggs = [F.count(F.lit(1)).alias("n_rows"), miss.alias("n_missing")]
    if target:
        y = qcol(target)
        aggs += [F.count(y).alias("target_nonnull"), F.count_if(y.isNull()).alias("target_null"),
                 F.countDistinct(y).alias("target_distinct")]
    r = df.agg(*aggs).select("*", F.lit(len(df.columns)).alias("n_columns"),
                             *[F.lit(v).alias(f"n_{k}") for k, v in kinds.items()])
    if target:
        r = r.withColumn("target_null_pct", F.col("target_null") * 100.0 / F.col("n_rows"))
    return r


def target_report(df: DataFrame, target: str, order_by: str, n: int = 10) -> DataFrame:
    """One row: the target's type and its first ``n`` values in the order of a column (nulls as 'NULL'), joined by commas."""
    first = df.select(qcol(order_by).alias("o"), qcol(target).cast("string").alias("v")).orderBy("o").limit(n)
    head = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o", "v"))), lambda x: x["v"]), ",", "NULL")
    return first.agg(F.lit(df.schema[target].dataType.simpleString()).alias("target_type"), head.alias("target_head"))
