"""Running totals over an ordered key inside groups, without a single-partition window.

``running_totals`` expects one row per (group keys, order value) – e.g. counts per distinct
score – and returns inclusive running sums in the requested direction. One form for every size:

1. range-partition on (keys, order value) and checkpoint, which fixes the partitions;
2. sum inside (partition, group);
3. per-partition totals (one row per partition and group) give the offset of each partition
   and the group total, joined back null-safe.

Work is spread over all partitions even when one group holds everything. NULL keys are a group.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalar import qcol
from ..session import cut_lineage


def running_totals(df: DataFrame, keys: list[str], order, values: list[str], descending: bool = True,
                   prefix: str = "cum_", n_parts: int | None = None, totals: bool = False) -> DataFrame:
    """``order``: a column name (direction from ``descending``) or a list of sort Columns.
    ``totals``: also add ``tot_<v>`` (group total). ``n_parts``: number of range partitions."""
    by = _order(order, descending)
    ranges = [qcol(k) for k in keys] + by
    parted = df.repartitionByRange(n_parts, *ranges) if n_parts else df.repartitionByRange(*ranges)
    parted = cut_lineage(parted.withColumn("_pid", F.spark_partition_id()))
    own = Window.partitionBy("_pid", *keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parted.select("*", *[F.sum(v).over(own).alias(prefix + v) for v in values])
    sums = parted.groupBy("_pid", *keys).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))  # one row per partition
    before = group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sums.select(F.col("_pid").alias("_p"), *[qcol(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                       *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values],
                       *[F.sum(f"_t_{v}").over(group).alias(f"tot_{v}") for v in values])
    same = reduce(lambda a, b: a & b, [qcol(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)],
                  F.col("_pid") == F.col("_p"))
    out = local.join(offs, same).withColumns({prefix + v: F.col(prefix + v) + F.col(f"_o_{v}") for v in values})
    return out.select(*[qcol(c) for c in df.columns], *[prefix + v for v in values],
                      *([f"tot_{v}" for v in values] if totals else []))


def _order(order, descending):
    if isinstance(order, str):
        return [F.col(order).desc() if descending else F.col(order).asc()]
    return list(order)
