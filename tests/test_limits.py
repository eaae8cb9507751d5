"""Inputs beyond the oracle's: null keys, wide or constant columns, repeated keys, rows without neighbours."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import clean, evaluate as ev, features as ft, knn, mice, profile as pf, splits, transform as tf
from stratum.plans import prepare, tables as tb
from stratum.session import scratch_path


def test_curves_keep_null_groups(spark):
    df = spark.range(40).select(F.when(F.col("id") % 2 == 0, "a").alias("g"), (F.col("id") % 3 == 0).cast("int").alias("y"),
                                (F.col("id") / 40).alias("score"))
    assert {r["g"] for r in ev.roc_auc(df, ["g"]).collect()} == {"a", None}


def test_correlation_of_many_nullable_columns(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 65))
    x[:, 64] = 3.5
    x[rng.random(x.shape) < 0.1] = np.nan
    cols = [f"c{i}" for i in range(65)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], cols).repartition(3)
    got = {(r.col_a, r.col_b): r["corr"] for r in pf.correlation_matrix(df, cols).collect()}
    assert len(got) == 65 * 64 // 2
    for i, j in ((0, 1), (5, 40), (62, 63)):
        ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[cols[i], cols[j]] == pytest.approx(np.corrcoef(x[ok, i], x[ok, j])[0, 1])
    assert got["c0", "c64"] is None
    assert {g.column for g in pf.high_corr_groups(df, cols, 0.9).collect()} <= set(cols)
    assert ft.reduce_correlated(df, cols)[0].columns


def test_nulls_and_zeros_of_many_columns(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 3, (200, 130)).astype(float)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = 1.0                        # never null
    x[:, 8] = np.nan                     # always null
    cols = [f"c{i}" for i in range(130)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{c} double" for c in cols)).repartition(3)
    null = np.isnan(x)
    r = pf.missing_totals(df, cols).first()
    assert (r.n_cells, r.n_missing) == (200 * 130, null.sum()) and r.pct_missing == pytest.approx(100 * null.mean(), abs=1e-6)
    z = pf.sparsity(df, cols).first()
    assert (z.n_zero, z.n_cells) == ((x == 0).sum(), 200 * 130)
    got = {(r.col_a, r.col_b): r["corr"] for r in pf.nullity_correlation(df, cols).collect()}
    assert len(got) == 130 * 129 // 2 and got["c0", "c7"] is None and got["c8", "c9"] is None
    for i, j in ((0, 1), (6, 100), (128, 129)):
        assert got[cols[i], cols[j]] == pytest.approx(np.corrcoef(null[:, i], null[:, j])[0, 1])
    assert pf.missing_totals(df.limit(0), cols).first().n_cells == 0


def test_empty_and_constant_columns(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), F.lit(None).cast("double").alias("b"), F.lit(2.0).alias("c"))
    assert clean.cap_outliers(df, ["a", "b", "c"])[0].count() == 50
    assert clean.remove_outliers_iqr(df, ["a", "b"]).count() == 50
    out = tf.yeo_johnson(df, ["a", "b", "c"])[0]
    assert {r["c_transformed"] for r in out.collect()} == {2.0} and out.where("b_transformed is null").count() == 50


def test_prepare_with_a_constant_column(spark, sf_dir):
    s = tb.study(spark, sf_dir).limit(300).withColumn("X2", F.lit(1.0))
    x, params = prepare.prepare_fit(s, impute="median")
    assert x.count() == s.count() and prepare.prepare_apply(s, params).columns == x.columns


def test_mice_keeps_rows_with_repeated_keys(spark):
    rng = np.random.default_rng(0)
    a = rng.standard_normal(200)
    rows = [(i // 2, float(v), None if i % 7 == 0 else float(2 * v + 1)) for i, v in enumerate(a)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double")
    for estimator in ("ridge", "gbt"):
        out = mice.impute_mice(df, ["a", "b"], max_iter=2, estimator=estimator, gbt_iter=3)
        assert out.count() == 200 and out.where("b is null").count() == 0 and out.columns == df.columns
    # the linear relation is recovered
    out = mice.impute_mice(df, ["a", "b"])
    assert out.agg(F.max(F.abs(F.col("b") - 2 * F.col("a") - 1))).first()[0] < 0.01


def test_fallback_on_any_failure(spark):
    df = spark.createDataFrame([(i, float(i), None if i % 2 else 1.0) for i in range(20)], "row_id long, a double, b double")
    with pytest.warns(UserWarning):
        out, tag = mice.impute_with_fallback(df, ["a", "b"], "mice", estimator="ridge", max_iter="none")
    assert tag == "mice_backup" and out.where("b is null").count() == 0


def test_tuning_counts_every_hidden_cell(spark):
    rows = [(i, float(i % 10), float(i % 10) * 2) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double")
    got = knn.tune_knn_k(df, ["a", "b"], k_values=[1, 3], folds=3, hide=0.95).collect()
    assert len(got) == 2 and sum(r.best for r in got) == 1 and all(r["mean"] > 0 for r in got)


def test_saved_knn_preparation_and_correlated_drop(spark, sf_dir):
    s = tb.study(spark, sf_dir).limit(400)
    x, params = prepare.prepare_fit(s, impute="knn", corr_threshold=0.95)
    path = scratch_path(spark, "prepared")
    prepare.save_prepared(params, path)
    new = tb.study(spark, sf_dir).where("row_id % 50 = 0")
    out = prepare.prepare_apply(new, prepare.load_prepared(spark, path))
    assert out.columns == x.columns and out.count() == new.count()
    assert out.where("X1_transformed is null").count() == 0


def test_variants_impute_once_each(spark, sf_dir):
    s = tb.study(spark, sf_dir).limit(400)
    got = prepare.variant_matrix(s, impute=("median", "mice"), max_iter=2)
    assert set(got) == {(m, c) for m in ("median", "mice") for c in ("capped", "uncapped")}
    a, b = got["mice", "capped"], got["mice", "uncapped"]
    assert a.columns == b.columns and a.count() == b.count() == 400


def test_class_rank_keeps_null_keys_and_sorts_rows_once(spark, monkeypatch):
    monkeypatch.setattr(splits, "BUCKET_ROWS", 10)  # several buckets a class
    cls = F.when(F.col("id") % 5 != 0, F.col("id") % 3 == 0)  # true, false and null
    df = spark.range(300).select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("row_id"), cls.alias("y"))
    ranked = splits.class_rank(df, "y")
    found = ranked.collect()
    for c in (True, False, None):
        of_class = [r for r in found if r.y is c]
        assert sorted(r._rank for r in of_class) == list(range(sum(r.y is c for r in df.collect())))
        ids = [r.row_id for r in sorted(of_class, key=lambda r: r._rank) if r.row_id is not None]
        assert ids == sorted(ids, key=lambda i: (int(hashlib.md5(f"42|{i}".encode()).hexdigest()[:8], 16), i))
    plan = ranked._jdf.queryExecution().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan  # later passes only look the bucket up
