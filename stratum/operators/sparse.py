"""Wide sparse binary tables as (row_id, feature) pairs: presence, co-occurrence and phi correlations.

A row of the long form says that a binary feature is one in a row; everything else is zero. One shuffle brings the
features of a row together as a set (repeated pairs count once, summed up before the shuffle). Tasks then
work on blocks of ``BLOCK`` rows as sums of outer products:

* features that are one in more than ``RARE`` of a block's rows are held as bitmaps, and a pair of them is the
  number of bits of an AND, so that a feature which is nearly always one makes no pairs of rows;
* each one of a rarer feature is paired with all ones of its row.

Both give exact counts; a task adds up its blocks and passes on one row per pair that occurs. Rows without any
one count through ``n_rows`` only. Null rows or features are left out. The number of columns may grow to some
thousands (the list of features and their counts are column metadata, and are on the driver); rows are unbounded.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.scalar import qcol
from ..session import cut_lineage, ship

BLOCK = 1 << 14
RARE = 1 / 128
#: Pairs that a task adds up at a time.
_HELD = 1 << 21


def to_sparse(df: DataFrame, cols: list[str], key: str = "row_id") -> DataFrame:
    """(row_id, feature) of the cells of ``cols`` that are one; nulls and zeros have no row."""
    ones = F.filter(F.array(*[F.when(qcol(c) == 1, F.lit(c)) for c in cols]), lambda c: c.isNotNull())
    return df.select(qcol(key).alias(key), F.explode(ones).alias("feature"))


def sparse_presence_rates(ones: DataFrame, n_rows: int, key: str = "row_id") -> DataFrame:
    """(column, n_ones, presence_pct) of every feature that occurs, over ``n_rows`` rows."""
    pairs = ones.where(F.col(key).isNotNull() & F.col("feature").isNotNull()).select(key, "feature").distinct()
    counts = pairs.groupBy(F.col("feature").alias("column")).agg(F.count(F.lit(1)).alias("n_ones"))
    return counts.withColumn("presence_pct", F.round(F.col("n_ones") * 100.0 / F.lit(n_rows), 6))


def block_pairs(row: np.ndarray, feature: np.ndarray, n_rows: int, p: int, rare: float = RARE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs a <= b of features (as a * p + b) that occur together in a block and in how many rows; ones by row."""
    count = np.bincount(feature, minlength=p)
    often = count > rare * n_rows
    keys, sums = [], []
    # frequent with frequent: bits of the AND of two bitmaps
    names = np.flatnonzero(often)
    if len(names):
        place = np.zeros(p, dtype=np.int64)
        place[names] = np.arange(len(names))
        dense = np.zeros((len(names), -(-n_rows // 64) * 64), dtype=bool)
        hit = often[feature]
        dense[place[feature[hit]], row[hit]] = True
        bits = np.packbits(dense, axis=1).view(np.uint64)
        for i in range(len(names)):
            both = np.bitwise_count(bits[i:] & bits[i]).sum(axis=1, dtype=np.int64)
            some = np.flatnonzero(both)
            keys.append(names[i] * p + names[i:][some])
            sums.append(both[some])
    # each one of a rare feature with all ones of its row
    first = np.searchsorted(row, np.arange(n_rows + 1))
    at = np.flatnonzero(~often[feature])
    width = np.diff(first)[row[at]]
    step = np.searchsorted(np.cumsum(width), np.arange(0, int(width.sum()) + 1, _HELD))
    for lo, hi in zip(step, [*step[1:], len(at)]):
        a, w = at[lo:hi], width[lo:hi]
        other = np.repeat(first[row[a]], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        f, g = np.repeat(feature[a], w), feature[other]
        keep = often[g] | (f <= g)  # two rare features meet twice
        key, n = np.unique(np.minimum(f, g)[keep] * p + np.maximum(f, g)[keep], return_counts=True)
        keys.append(key)
        sums.append(n)
    return _merge(keys, sums)


def _merge(keys: list, sums: list) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k, s = np.concatenate(keys).astype(np.int64), np.concatenate(sums).astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, s = k[order], s[order]
    edge = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[edge], np.add.reduceat(s, edge) if len(k) else s


def cooccurrence(ones: DataFrame, key: str = "row_id", features: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """(feature_a, feature_b, n_both) of all pairs of features that are one in the same row, a <= b in the
    features' order (by name unless given); with a = b the number of ones of a feature."""
    spark = ones.sparkSession
    ship(spark)
    ones = ones.where(F.col(key).isNotNull() & F.col("feature").isNotNull()).select(F.col(key).alias("k"), F.col("feature").cast("string").alias("feature"))
    if features is None:
        features = sorted(r[0] for r in ones.select("feature").distinct().collect())
    p = len(features)
    schema = "feature_a string, feature_b string, n_both long"
    if not p:
        return spark.createDataFrame([], schema)
    names = spark.createDataFrame(list(enumerate(features)), "f int, feature string")
    rows = ones.join(F.broadcast(names), "feature").groupBy("k").agg(F.collect_set("f").alias("fs")).select("fs")

    def run(batches):
        keys, sums, held = [], [], 0
        for b in batches:
            for lo in range(0, b.num_rows, block):
                fs = b.column("fs").slice(lo, block)
                size = fs.value_lengths().to_numpy(zero_copy_only=False)
                feature = fs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                k, s = block_pairs(np.repeat(np.arange(len(size)), size), feature, len(size), p)
                keys.append(k)
                sums.append(s)
                held += len(k)
                if held > _HELD:
                    k, s = _merge(keys, sums)
                    keys, sums, held = [k], [s], len(k)
                if held > _HELD:  # too many pairs to keep
                    yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(sums[0])], names=["pair", "n"])
                    keys, sums, held = [], [], 0
        k, s = _merge(keys, sums)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(s)], names=["pair", "n"])

    pairs = rows.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n_both"))
    pairs = pairs.select(F.expr(f"int(pair div {p})").alias("a"), (F.col("pair") % p).cast("int").alias("b"), "n_both")
    for side in "ab":
        pairs = pairs.join(F.broadcast(names.select(F.col("f").alias(side), F.col("feature").alias(f"feature_{side}"))), side)
    return pairs.select("feature_a", "feature_b", "n_both")


def _phi(both, a, b, n: int):
    n, both, a, b = F.lit(float(n)), both.cast("double"), a.cast("double"), b.cast("double")
    spread = a * (n - a) * b * (n - b)
    return F.when(spread > 0, (n * both - a * b) / F.sqrt(spread))


def phi_pairs(counts: DataFrame, n_rows: int) -> DataFrame:
    """(feature_a, feature_b, n_both, corr) of the pairs a < b that occur together; null for constant features.

    ``counts``: a ``cooccurrence`` result. The phi coefficient is Pearson's r of two binary columns."""
    ones = counts.where("feature_a = feature_b").select(F.col("feature_a").alias("f"), F.col("n_both").alias("n"))
    pairs = counts.where("feature_a <> feature_b")
    for side in "ab":
        pairs = pairs.join(ones.select(F.col("f").alias(f"feature_{side}"), F.col("n").alias(f"n_{side}")), f"feature_{side}")
    return pairs.select("feature_a", "feature_b", "n_both", _phi(F.col("n_both"), F.col("n_a"), F.col("n_b"), n_rows).alias("corr"))


def sparse_correlation_matrix(ones: DataFrame, n_rows: int, features: list[str], key: str = "row_id") -> DataFrame:
    """Long matrix (col_a, col_b, corr) for all pairs i < j of ``features``, as ``profile.correlation_matrix`` has it; pairs
    that never occur together, and features without any one, included."""
    spark = ones.sparkSession
    counts = cut_lineage(cooccurrence(ones, key, features))
    alone = {r.feature_a: r.n_both for r in counts.where("feature_a = feature_b").collect()}
    every = spark.createDataFrame([(i, f, alone.get(f, 0)) for i, f in enumerate(features)], "i int, f string, n long")
    last = len(features) - 1
    left = every.where(F.col("i") < last).select(F.explode(F.sequence(F.col("i") + 1, F.lit(last))).alias("j"), F.col("f").alias("col_a"), F.col("n").alias("n_a"))
    pairs = left.join(every.select(F.col("i").alias("j"), F.col("f").alias("col_b"), F.col("n").alias("n_b")), "j")
    both = counts.select(F.col("feature_a").alias("col_a"), F.col("feature_b").alias("col_b"), "n_both")
    pairs = pairs.join(both, ["col_a", "col_b"], "left")
    return pairs.select("col_a", "col_b", _phi(F.coalesce("n_both", F.lit(0)), F.col("n_a"), F.col("n_b"), n_rows).alias("corr"))
