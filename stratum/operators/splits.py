"""Deterministic stratified splits, folds and row samples.

Randomness comes only from ``portable_hash(key, seed)``. The exact modes need each row's
rank inside its class; ``class_rank`` gets it without a per-class single-partition window:
rows are cut into hash-prefix buckets (sized from the class counts) and only rows inside one
bucket are ordered together. The ordered rows are checkpointed; their bucket sizes give exclusive
offsets through running totals over the small (class, bucket) count table, which is broadcast.
So the whole rank hashes every row once and costs one shuffle, and callers need no checkpoint of their own.

``stratified_split`` needs no rank: rows are hashed and checkpointed where they are (within a partition in the order of class
and hash, which seeded engines draw by), counts find the first row after each cut, and a row's split is a comparison with it.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import portable_hash
from ..functions.scalar import qcol
from ..session import cut_lineage
from .running import running_totals

BUCKET_ROWS = 100_000
#: Bits below the class number in a row's place (32 of the hash, and its null), and those that the first pass leaves out.
_CLASS_BITS, _LOW_BITS = 33, 17


def class_counts(df: DataFrame, target: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(qcol(target)).count().collect()}


def class_rank(df: DataFrame, target: str, key: str = "row_id", seed: int = 42,
               counts: dict | None = None, out: str = "_rank") -> DataFrame:
    """0-based rank of each row inside its class, ordered by (portable_hash(key, seed), key)."""
    counts = counts or class_counts(df, target)
    biggest = max(counts.values()) if counts else 0
    bits = min(32, max(0, math.ceil(math.log2(max(biggest, 1) / BUCKET_ROWS)))) if biggest > BUCKET_ROWS else 0
    h = portable_hash(key, seed)
    d = (df.withColumn("_c", qcol(target)).withColumn("_h", h)
           .withColumn("_b", F.coalesce(F.shiftright(F.col("_h"), 32 - bits), F.lit(0)) if bits else F.lit(0).cast("bigint")))
    number = F.when(F.lit(False), -1)  # of the class; one number names a bucket
    for i, c in enumerate(counts):
        number = number.when(F.col("_c").eqNullSafe(F.lit(c)), i)
    bucket = F.coalesce(number, F.lit(len(counts))).cast("bigint") * F.lit(1 << bits) + F.col("_b")
    w = Window.partitionBy("_c", "_b").orderBy("_h", key)
    d = cut_lineage(d.withColumn("_at", F.row_number().over(w)).withColumn("_k", bucket).drop("_h", "_b", "_c"))
    sizes = d.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).withColumn("_c", F.shiftright("_k", bits))
    offs = running_totals(sizes, ["_c"], "_k", ["_n"], descending=False, prefix="_cum")
    offs = cut_lineage(offs.select("_k", (F.col("_cum_n") - F.col("_n")).alias("_off")))  # one row per bucket
    j = d.join(F.broadcast(offs), "_k").withColumn("_at", F.col("_off") + F.col("_at") - 1)
    return j.select(*[qcol(c) for c in df.columns], F.col("_at").alias(out))


def allocate(total: int, counts: dict) -> dict:
    """Split ``total`` over classes proportionally: floors, then largest remainders
    (ties to the smaller class label)."""
    n = sum(counts.values())
    if n == 0:
        return {c: 0 for c in counts}
    cont = {c: total * v / n for c, v in counts.items()}
    out = {c: int(math.floor(x)) for c, x in cont.items()}
    need = total - sum(out.values())
    order = sorted(counts, key=lambda c: (-(cont[c] - out[c]), c))
    for c in order[:need]:
        out[c] += 1
    return out


def split_sizes(counts: dict, test: float = 0.2, val: float = 0.2) -> tuple[dict, dict]:
    """Per class test and validation sizes: test = ceil(test*n); validation drawn from the
    rest with share val/(1-test), also rounded up (two-step 80/20 then 75/25 split)."""
    n = sum(counts.values())
    n_test = math.ceil(test * n)
    t = allocate(n_test, counts)
    rest = {c: counts[c] - t[c] for c in counts}
    n_val = math.ceil(val / (1 - test) * (n - n_test)) if val > 0 else 0
    v = allocate(n_val, rest)
    return t, v


def stratified_split(df: DataFrame, target: str, test: float = 0.2, val: float = 0.2,
                     key: str = "row_id", seed: int = 42, exact: bool = True) -> DataFrame:
    """Adds ``split`` in {train, val, test}, stratified on ``target``.

    exact=True: per-class sizes as in ``split_sizes`` (rows taken in hash order: test first,
    then val); the rows are checkpointed. exact=False: one hash threshold per row (stratified in expectation, no shuffle)."""
    if not exact:
        u = portable_hash(key, seed) / F.lit(4294967296.0)
        return df.withColumn("split", F.when(u < test, "test").when(u < test + val, "val").otherwise("train"))
    counts = class_counts(df, target)
    t, v = split_sizes(counts, test, val)
    if any(c is None for c in counts):
        raise ValueError("target has nulls: drop or fill them before splitting")
    classes = sorted(counts)
    kept = cut_lineage(df.withColumn("_k", _place(qcol(target), classes, portable_hash(key, seed)))
                         .sortWithinPartitions("_k").withColumn("_n", F.monotonically_increasing_id()))
    before, ranks = 0, []
    for c in classes:
        ranks += [before + t[c], before + t[c] + v[c]]
        before += counts[c]
    first = _first_after(kept, ranks, key)
    out = F.lit("train")
    for i in reversed(range(len(classes))):  # the classes follow one another in the order of _k
        out = (F.when(F.col("_k") >= F.lit((i + 1) << _CLASS_BITS), out)
                .when(first[2 * i], "test").when(first[2 * i + 1], "val").otherwise("train"))
    return kept.withColumn("split", out).drop("_k", "_n")


def _place(target: Column, classes: list, h: Column) -> Column:
    """One number that orders rows by class, then hash (a null hash first)."""
    number = F.lit(None)
    for i, c in reversed(list(enumerate(classes))):
        number = F.when(target == F.lit(c), i << _CLASS_BITS).otherwise(number)
    return number.cast("bigint") + F.coalesce(h + 1, F.lit(0).cast("bigint"))


def _first_after(kept: DataFrame, ranks: list[int], key: str) -> list[Column]:
    """For each rank, whether a row is one of the first ``rank`` rows in the order (_k, key, _n).

    Two passes find the _k of the row at the rank: counts by its upper bits, then counts of the values in the ranks' blocks (at
    most 2^17 each). Only where rows of that _k lie on both sides of the rank, one more pass finds the row itself."""
    blocks = sorted(kept.groupBy(F.shiftright("_k", _LOW_BITS).alias("b")).count().collect())
    wanted = {r: _spot(blocks, r) for r in set(ranks)}
    inside = sorted({b for b, _ in wanted.values() if b is not None})
    rows = kept.where(F.shiftright("_k", _LOW_BITS).isin(inside)).groupBy("_k").count().collect() if inside else []
    within: dict[int, list] = {}
    for k, n in sorted(rows):
        within.setdefault(k >> _LOW_BITS, []).append((k, n))
    found = {}
    for r, (b, under) in wanted.items():
        if b is None:
            found[r] = F.lit(True)
            continue
        k, below = _spot(within[b], r - under)
        found[r] = F.col("_k") < F.lit(k)
        if r > under + below:
            at = kept.where(F.col("_k") == F.lit(k)).orderBy(qcol(key), "_n").select(qcol(key).alias("key"), "_n").offset(r - under - below).limit(1).first()
            earlier = F.col("_n") < F.lit(at["_n"])
            if at["key"] is not None:  # null keys have a _k of their own
                earlier = (qcol(key) < F.lit(at["key"])) | ((qcol(key) == F.lit(at["key"])) & earlier)
            found[r] = found[r] | ((F.col("_k") == F.lit(k)) & earlier)
    return [found[r] for r in ranks]


def _spot(counted: list, rank: int) -> tuple:
    """(value, rows before it) of the row at the 0-based rank among (value, count) in order; (None, all rows) beyond the last."""
    under = 0
    for value, n in counted:
        if rank < under + n:
            return value, under
        under += n
    return None, under


def stratified_folds(df: DataFrame, target: str, n_folds: int = 5, key: str = "row_id",
                     seed: int = 42, exact: bool = True) -> DataFrame:
    """Adds ``fold`` in [0, n_folds): class rank modulo n_folds (exact balance), or the hash
    modulo n_folds (exact=False, no shuffle)."""
    if not exact:
        return df.withColumn("fold", F.pmod(portable_hash(key, seed), F.lit(n_folds)).cast("int"))
    return class_rank(df, target, key, seed).withColumn("fold", (F.col("_rank") % n_folds).cast("int")).drop("_rank")


def sample_rows(df: DataFrame, n: int, key: str = "row_id", seed: int = 42,
                with_replacement: bool = False, fraction: float | None = None) -> DataFrame:
    """n rows without replacement: the n smallest (hash, key) – a TakeOrdered, no full sort.
    With replacement: n draws (``fraction``: that share of the rows), each the row at a hashed position."""
    if with_replacement:
        total = df.count()
        n = n if fraction is None else int(round(fraction * total))
        if not total:
            return df
        at = class_rank(df.withColumn("_one", F.lit(1)), "_one", key, seed, counts={1: total}, out="_at").drop("_one")
        wide = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:draw|"), F.col("id").cast("string"))), 1, 15), 16, 10).cast("long")
        draws = df.sparkSession.range(n).select((wide % total).alias("_at"))
        return draws.join(at, "_at").drop("_at")
    return df.orderBy(portable_hash(key, seed), key).limit(n)


def stratified_column_sample(rates: DataFrame, per_quartile: int = 10, seed: int = 42,
                             value: str = "presence_pct", name: str = "column") -> DataFrame:
    """``per_quartile`` columns from each presence-rate quartile of a per-feature table."""
    q = rates.agg(F.percentile(value, [0.25, 0.5, 0.75]).alias("q")).first()["q"]
    v = F.col(value)
    quart = (F.when(v <= q[0], 1).when(v <= q[1], 2).when(v <= q[2], 3).otherwise(4))
    w = Window.partitionBy("quartile").orderBy(portable_hash(F.col(name), seed), name)
    return (rates.withColumn("quartile", quart).withColumn("_r", F.row_number().over(w))
                 .where(F.col("_r") <= per_quartile).drop("_r"))
