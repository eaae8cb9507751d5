"""Profiling aggregates (missingness, moments, quantiles, correlation, histograms).

Wide tables: per-column statistics are computed as single-row aggregates in chunks of at
most ``AGG_LIMIT`` aggregate functions (small enough for whole-stage codegen); each chunk
scans only its own Parquet columns, so total I/O equals one pass while plans stay small. Results are unpivoted to a long
``(column, ...)`` form. Nothing but per-column statistics reaches the driver.
"""
from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalar import qcol, safe_div
from ..session import cut_lineage
from .quantiles import exact_quantiles

CHUNK = 200
AGG_LIMIT = 40   # aggregate functions per pass: keeps the buffer under the codegen field limit


def _numeric_cols(df: DataFrame, exclude=()) -> list[str]:
    num = ("double", "float", "int", "bigint", "smallint", "tinyint") 
    return [c for c, t in df.dtypes if (t in num or t.startswith("decimal")) and c not in exclude]


def _long_stats(df: DataFrame, cols: list[str], stat_fns: dict) -> DataFrame:
    """One aggregate per chunk -> long table ``(column, <stat>...)`` (lazy, union of chunks)."""
    parts = []
    per = max(1, min(CHUNK, AGG_LIMIT // max(len(stat_fns), 1)))   # aggregates per pass
    for i in range(0, len(cols), per):
        chunk = cols[i:i + per]
        aggs = []
        for j, c in enumerate(chunk):
            aggs += [fn(qcol(c)).alias(f"{s}__{j}") for s, fn in stat_fns.items()]
        row = df.agg(*aggs)
        structs = [F.struct(F.lit(c).alias("column"),
                            *[F.col(f"{s}__{j}").alias(s) for s in stat_fns])
                   for j, c in enumerate(chunk)]
        parts.append(row.select(F.inline(F.array(*structs))))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------------------------- missingness
def missing_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column missing count and % (only columns with missing values), sorted desc."""
    cols = cols or df.columns
    n = F.count(F.lit(1))
    st = _long_stats(df, cols, {"n_missing": lambda c: F.count_if(c.isNull()).cast("bigint"),
                                "n_rows": lambda c: n})
    return (st.where("n_missing > 0")
              .select("column", "n_missing",
                      F.round(F.col("n_missing") * 100.0 / F.col("n_rows"), 6).alias("pct_missing"))
              .orderBy(F.desc("n_missing"), "column"))


def missing_totals(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: cells, missing cells, % missing."""
    cols = cols or df.columns
    counts = _long_stats(df, cols, {"n": lambda c: F.count(F.lit(1)), "m": lambda c: F.count_if(c.isNull())})
    return (counts.agg(F.sum("n").alias("n_cells"), F.sum("m").alias("n_missing"))
              .withColumn("pct_missing", F.round(safe_div(F.col("n_missing") * 100, F.col("n_cells")), 6)))


def _null_count_expr(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [qcol(c).isNull().cast("int") for c in cols])


def missing_per_row(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distribution of the number of missing cells per row."""
    cols = cols or df.columns
    return (df.select(_null_count_expr(cols).alias("n_missing"))
              .groupBy("n_missing").agg(F.count(F.lit(1)).alias("n_rows")))


def _pattern(cols: list[str]) -> Column:
    return F.concat(*[F.when(qcol(c).isNull(), "1").otherwise("0") for c in cols])


def missing_patterns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per null pattern ('1' = missing, in ``cols`` order)."""
    total = df.count()
    return (df.select(_pattern(cols).alias("pattern"))
              .groupBy("pattern").agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("pct_rows", F.round(F.col("n_rows") * 100.0 / F.lit(total), 6)))


def frequent_patterns(df: DataFrame, cols: list[str], share: float = 0.01) -> DataFrame:
    """(pattern, n_rows, pct_rows) of the null patterns of at least ``share`` of all rows, exact, and a row with a null
    pattern for all other rows (where there are any).

    For wide tables, where nearly every row can have its own pattern. Each task keeps 1 / share counters of
    the Space-Saving summary over its rows; a pattern of that share of all rows has it in some task, and is then
    among that task's counters. A second pass counts the candidates exactly; nothing else is shuffled."""
    spark, size = df.sparkSession, int(1 / share) + 1
    masks = df.select(_pattern(cols).alias("pattern"))

    def summary(batches):
        held: dict[str, int] = {}
        least: list[tuple[int, str]] = []  # a heap of possibly old counts
        for b in batches:
            for v in b.column(0).value_counts().to_pylist():
                p, n = v["values"], v["counts"]
                if p in held:
                    held[p] += n
                    continue
                if len(held) >= size:
                    while True:  # the smallest count gives its place, and its count, to the new pattern
                        c, old = heapq.heappop(least)
                        if held.get(old) == c:
                            break
                        if old in held:
                            heapq.heappush(least, (held[old], old))
                    del held[old]
                    n += c
                held[p] = n
                heapq.heappush(least, (n, p))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string())], names=["pattern"])

    candidates = masks.mapInArrow(summary, "pattern string").distinct()
    counts = masks.join(candidates, "pattern", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("n_rows"))
    total = df.count()
    found = cut_lineage(counts.where(F.col("n_rows") >= share * total))
    told = found.agg(F.sum("n_rows")).first()[0] or 0
    rest = spark.createDataFrame([(None, total - told)] if total > told else [], "pattern string, n_rows long")
    return found.unionByName(rest).withColumn("pct_rows", F.round(F.col("n_rows") * 100.0 / F.lit(total), 6))


def _corr(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson r; NULL when either side is constant (never raises)."""
    both = x.isNotNull() & y.isNotNull()
    xm, ym = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    den = F.stddev_pop(xm) * F.stddev_pop(ym)
    return F.when(den > 0, F.covar_pop(xm, ym) / den)


def nullity_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of null indicators for every column pair (i < j); NULL where one never or always is null."""
    return correlation_matrix(df.select(*[qcol(c).isNull().cast("int").alias(c) for c in cols]), cols)


def missing_vs_target(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """corr(isnull(col), target) per column (MAR evidence)."""
    y = qcol(target)
    return _long_stats(df, cols, {"corr": lambda c: _corr(c.isNull().cast("int"), y)})


# ---------------------------------------------------------------- target / kinds
def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and % per class, and imbalance = max count / min count."""
    w = Window.partitionBy()
    return (df.groupBy(qcol(target).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("pct", F.round(F.col("n_rows") * 100.0 / F.sum("n_rows").over(w), 6))
              .withColumn("imbalance", F.round(F.max("n_rows").over(w) / F.min("n_rows").over(w), 6)))


def presence_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    """% of ones per binary column, denominator = all rows."""
    return (_long_stats(df, cols, {"n_ones": lambda c: F.count_if(c == 1).cast("bigint"),
                                   "n_rows": lambda c: F.count(F.lit(1))})
              .select("column", F.round(F.col("n_ones") * 100.0 / F.col("n_rows"), 6).alias("presence_pct")))


def presence_summary(rates: DataFrame) -> DataFrame:
    r = F.col("presence_pct")
    return rates.agg(F.round(F.avg(r), 6).alias("mean_pct"), F.round(F.median(r), 6).alias("median_pct"),
                     F.min(r).alias("min_pct"), F.max(r).alias("max_pct"))


def sparsity(df: DataFrame, cols: list[str]) -> DataFrame:
    """% of cells equal to zero over all listed binary columns."""
    counts = _long_stats(df, cols, {"z": lambda c: F.count_if(c == 0), "n": lambda c: F.count(F.lit(1))})
    return (counts.agg(F.sum("z").alias("n_zero"), F.sum("n").alias("n_cells"))
            .withColumn("pct_zero", F.round(F.col("n_zero") * 100.0 / F.col("n_cells"), 6)))


# ---------------------------------------------------------------- moments
def describe_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample std, min, q25, median, q75, max per column (exact quartiles)."""
    spark = df.sparkSession
    base = _long_stats(df, cols, {"count": lambda c: F.count(c).cast("bigint"),
                                  "mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c),
                                  "min": lambda c: F.min(c).cast("double"),
                                  "max": lambda c: F.max(c).cast("double")})
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    qdf = spark.createDataFrame([(c, *[None if v is None else float(v) for v in q[c]]) for c in cols],
                                "column string, q25 double, q50 double, q75 double")
    return base.join(F.broadcast(qdf), "column").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def shape_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Population skewness / excess kurtosis, and the bias-corrected (pandas) skewness."""
    st = _long_stats(df, cols, {"n": lambda c: F.count(c).cast("bigint"),
                                "skewness": lambda c: F.skewness(c), "kurtosis": lambda c: F.kurtosis(c)})
    n = F.col("n").cast("double")
    adj = F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.col("skewness"))
    return st.withColumn("skewness_adj", adj)


def normality_test(df: DataFrame, cols: list[str], alpha: float = 0.01) -> DataFrame:
    """Jarque-Bera over all rows: JB = n/6 (g1^2 + g2^2/4), p = exp(-JB/2) (chi2, 2 df)."""
    m = shape_moments(df, cols)
    jb = F.col("n") / 6.0 * (F.pow("skewness", 2) + F.pow("kurtosis", 2) / 4.0)
    return (m.select("column", "n", jb.alias("jb"))
             .withColumn("p_value", F.exp(-F.col("jb") / 2.0))
             .withColumn("normal", F.col("p_value") >= alpha))


def iqr_bounds(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """q1, q3, iqr, bounds q1 -/+ k*iqr, outlier count and % of non-null values."""
    spark = df.sparkSession
    cols = [c for c in cols if c in df.columns]
    q = exact_quantiles(df, cols, [0.25, 0.75])
    rows = []
    for c in cols:
        q1, q3 = q[c]
        if q1 is None:
            rows.append((c, None, None, None, None, None))
            continue
        iqr = q3 - q1
        rows.append((c, q1, q3, iqr, q1 - k * iqr, q3 + k * iqr))
    b = spark.createDataFrame(rows, "column string, q1 double, q3 double, iqr double, lower double, upper double")
    # outlier counts need the bounds: one more aggregate with literal bounds
    aggs = []
    for i, (c, q1, q3, iqr, lo, hi) in enumerate(rows):
        x = qcol(c)
        if lo is None:
            aggs += [F.lit(0).cast("bigint").alias(f"o{i}"), F.lit(0).cast("bigint").alias(f"n{i}")]
        else:
            aggs += [F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).cast("bigint").alias(f"o{i}"),
                     F.count(x).cast("bigint").alias(f"n{i}")]
    counts = df.agg(*aggs).first()
    crow = [(r[0], counts[f"o{i}"], counts[f"n{i}"]) for i, r in enumerate(rows)]
    c = spark.createDataFrame(crow, "column string, n_outliers bigint, n_nonnull bigint")
    return (b.join(c, "column")
             .withColumn("pct_outliers", F.round(safe_div(F.col("n_outliers") * 100, F.col("n_nonnull")), 6))
             .drop("n_nonnull"))


# ---------------------------------------------------------------- correlation
def target_correlation(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Pearson r of each column with the target (pairwise complete), sorted desc."""
    y = qcol(target)
    return (_long_stats(df, [c for c in cols if c != target], {"corr": lambda c: _corr(c, y)})
              .orderBy(F.desc_nulls_last("corr"), "column"))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long Pearson matrix ``(col_a, col_b, corr)`` for i < j, each pair over the rows where both are known.

    One pass at every width: each partition sums masked Gram blocks (counts, sums, squares and products of
    centred values), the partial rows are added per column, and the coefficients are computed
    there, so the matrix never comes to the driver. A column that is constant over the pair's rows gives NULL.
    """
    p, spark = len(cols), df.sparkSession
    schema = "col_a string, col_b string, corr double"
    if p < 2:
        return spark.createDataFrame([], schema)
    centre = []
    for s in range(0, p, CHUNK):
        centre += [0.0 if v is None else float(v) for v in df.agg(*[F.avg(qcol(c)).alias(f"m{i}") for i, c in enumerate(cols[s:s + CHUNK])]).first()]
    centre = np.array(centre)
    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]

    def partial(batches):
        total = np.zeros((4, p, p))
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(p)]) - centre
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            m = known.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        n, sx, sxx, sxy = total
        for i in range(p - 1):  # pairs of column i with the later ones
            values = [n[i, i + 1:], sx[i, i + 1:], sx[i + 1:, i], sxx[i, i + 1:], sxx[i + 1:, i], sxy[i, i + 1:]]
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array([v], pa.list_(pa.float64())) for v in values]], names=["i", *names])

    def finish(key, pdf):
        i = int(key[0])
        n, sx, sy, sxx, syy, sxy = (np.sum(np.stack(pdf[c].to_numpy()), axis=0) for c in names)
        with np.errstate(all="ignore"):
            vx, vy = sxx - sx * sx / n, syy - sy * sy / n
            r = (sxy - sx * sy / n) / np.sqrt(vx * vy)
        r[~((vx > 1e-12 * sxx) & (vy > 1e-12 * syy))] = np.nan
        return pd.DataFrame({"col_a": cols[i], "col_b": cols[i + 1:], "corr": pd.Series(r).astype(object).where(~np.isnan(r), None)})

    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # bounds the partial rows per column
    rows = df.select(*[qcol(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).coalesce(parts)
    sums = rows.mapInArrow(partial, "i int, " + ", ".join(f"{c} array<double>" for c in names))
    return sums.groupBy("i").applyInPandas(finish, schema)


def correlation_study(df: DataFrame, continuous: list[str], binary: list[str], target: str, per_quartile: int = 10,
                      threshold: float = 0.8, seed: int = 42) -> dict[str, DataFrame]:
    """Correlations of the continuous columns and of ``per_quartile`` binaries from each quartile of presence.

    ``ranking``: (column, corr) with the target, strongest first; ``pairs``: (col_a, col_b, corr) above ``threshold``;
    ``summary``: one row (n_columns, max_abs_target_corr, n_high_pairs)."""
    from .splits import stratified_column_sample
    picked = [r["column"] for r in stratified_column_sample(presence_rates(df, binary), per_quartile, seed).collect()]
    cols = list(continuous) + [c for c in binary if c in set(picked)]
    ranking = target_correlation(df, cols, target).orderBy(F.desc_nulls_last(F.abs("corr")), "column")
    pairs = cut_lineage(high_corr_pairs(correlation_matrix(df, cols), threshold))
    summary = ranking.agg(F.count(F.lit(1)).alias("n_columns"), F.max(F.abs("corr")).alias("max_abs_target_corr")).withColumn("n_high_pairs", F.lit(pairs.count()))
    return {"ranking": ranking, "pairs": pairs, "summary": summary}


def top_correlated(corr_long: DataFrame, n: int = 30) -> DataFrame:
    """n largest |r| rows of a ``target_correlation`` result."""
    return corr_long.where(F.col("corr").isNotNull()) \
                    .orderBy(F.desc(F.abs("corr")), "column").limit(n)


def high_corr_pairs(matrix_long: DataFrame, threshold: float = 0.8) -> DataFrame:
    return matrix_long.where(F.abs("corr") > threshold)


def high_corr_groups(df: DataFrame, cols: list[str], threshold: float = 0.9,
                     exclude: list[str] | None = None) -> DataFrame:
    """Greedy groups: for each unvisited column in order, itself plus *earlier* columns with
    |r| > threshold, sorted by name; first kept, rest dropped. Not transitive.

    The matrix is computed on Spark; the greedy pass runs over the small over-threshold
    edge list (column metadata) on the driver. Returns ``(group_id, column, keep)``.
    """
    exclude = set(exclude or [])
    cols = [c for c in cols if c not in exclude]
    pos = {c: i for i, c in enumerate(cols)}
    edges = (correlation_matrix(df, cols)
             .where(F.abs("corr") > threshold).select("col_a", "col_b").collect())
    earlier: dict[str, set] = {}
    for a, b in edges:
        lo, hi = (a, b) if pos[a] < pos[b] else (b, a)
        earlier.setdefault(hi, set()).add(lo)
    visited: set = set()
    rows = []
    gid = 0
    for c in cols:
        if c in visited or c not in earlier:
            continue
        group = sorted({c} | earlier[c])
        visited.update(group)
        gid += 1
        rows += [(gid, g, i == 0) for i, g in enumerate(group)]
    return df.sparkSession.createDataFrame(rows, "group_id int, column string, keep boolean")


# ---------------------------------------------------------------- distributions
def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width counts between min and max (last bin closed); empty bins absent."""
    x = qcol(col).cast("double")
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if mm["lo"] is None:
        return df.sparkSession.createDataFrame([], f"{by + ' string, ' if by else ''}bin int, bin_start double, n_rows bigint")
    lo, width = float(mm["lo"]), (float(mm["hi"]) - float(mm["lo"])) / bins
    b = (F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) if width > 0 else F.lit(0)).cast("int")
    keys = [qcol(by).alias(by)] if by else []
    return (df.where(x.isNotNull())
              .groupBy(*keys, b.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("bin_start", F.lit(lo) + F.col("bin") * F.lit(width))
              .select(*([by] if by else []), "bin", "bin_start", "n_rows"))


def five_number(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """min, q1, median, q3, max and Tukey whiskers per column (and per class)."""
    groups = [r[0] for r in df.select(qcol(by)).distinct().collect()] if by else [None]
    cells = [(c, g) for c in cols for g in groups]
    own = {f"v{i}": (F.when(qcol(by).eqNullSafe(F.lit(g)), qcol(c)) if by else qcol(c)).cast("double") for i, (c, g) in enumerate(cells)}
    view = df.select(*[v.alias(k) for k, v in own.items()])
    q = exact_quantiles(view, list(own), [0.0, 0.25, 0.5, 0.75, 1.0])
    rows = [(c, None if g is None else str(g), *q[f"v{i}"]) for i, (c, g) in enumerate(cells)]
    out = df.sparkSession.createDataFrame(rows, "column string, group string, min double, q1 double, median double, q3 double, max double")
    iqr = F.col("q3") - F.col("q1")
    return (out.withColumn("whisker_low", F.greatest(F.col("min"), F.col("q1") - 1.5 * iqr))
               .withColumn("whisker_high", F.least(F.col("max"), F.col("q3") + 1.5 * iqr)))


def split_summary(df: DataFrame, target: str = "y", keys=("variant", "split")) -> DataFrame:
    keys = [k for k in keys if k in df.columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.round(F.avg(qcol(target)), 6).alias("pos_share"))


def imputation_drift(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    """Mean/std before and after imputation, and their shifts."""
    st = {"mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c)}
    b = _long_stats(before, cols, st).withColumnsRenamed({"mean": "mean_before", "std": "std_before"})
    a = _long_stats(after, cols, st).withColumnsRenamed({"mean": "mean_after", "std": "std_after"})
    return (b.join(a, "column")
             .withColumn("mean_shift", F.col("mean_after") - F.col("mean_before"))
             .withColumn("std_shift", F.col("std_after") - F.col("std_before")))


def eda_summary(df: DataFrame, target: str, continuous: list[str], binary: list[str]) -> DataFrame:
    """One row: rows, columns, imbalance, sparsity of binaries, max |r| with target, kinds."""
    y = qcol(target)
    zeros = reduce(lambda a, b: a + b, [F.count_if(qcol(c) == 0).cast("bigint") for c in binary])
    corrs = [_corr(qcol(c), y) for c in continuous + binary]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(y == 1).alias("n_pos"), F.count_if(y == 0).alias("n_neg"),
                 zeros.alias("n_zero"),
                 F.array_max(F.filter(F.array(*[F.abs(r) for r in corrs]), lambda v: v.isNotNull())).alias("max_abs_corr"))
    return row.select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"),
        F.round(F.greatest("n_pos", "n_neg") / F.least("n_pos", "n_neg"), 6).alias("imbalance"),
        F.round(F.col("n_zero") * 100.0 / (F.col("n_rows") * len(binary)), 6).alias("sparsity_pct"),
        F.round("max_abs_corr", 6).alias("max_abs_corr"),
        F.lit(len(continuous)).alias("n_continuous"), F.lit(len(binary)).alias("n_binary"))
