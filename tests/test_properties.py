"""Properties of fit/apply operators, scalable paths vs simple paths."""
import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from stratum.operators import clean, evaluate as ev, quantiles as qt, running, splits as sp, transform as tf
from stratum.plans import tables as tb
from stratum.session import scratch_path
from stratum.sources import sinks


def test_capped_inside_bounds_and_nulls_kept(spark, sf_dir):
    s = tb.study(spark, sf_dir).select("row_id", "X1", "X2")
    capped, params = clean.cap_outliers(s, ["X1", "X2"])
    b = {(r["column"], r["param"]): r["value"] for r in params.collect()}
    r = capped.agg(F.min("X1"), F.max("X1"), F.count_if(F.col("X1").isNull())).first()
    assert r[0] >= b[("X1", "lower")] - 1e-9 and r[1] <= b[("X1", "upper")] + 1e-9
    assert r[2] == s.where("X1 IS NULL").count()


def test_params_roundtrip_apply_equal(spark, sf_dir):
    s = tb.study(spark, sf_dir).select("row_id", "X1", "X2", "X3")
    p = tf.fit_power(s, ["X1", "X2"], "yeo-johnson")
    path = scratch_path(spark, "t-params")
    sinks.save_params(p, path)
    a = tf.apply_power(s, p, "yeo-johnson").orderBy("row_id").collect()
    b = tf.apply_power(s, sinks.load_params(spark, path), "yeo-johnson").orderBy("row_id").collect()
    assert a == b


def test_auc_invariant_under_monotone_change(spark, sf_dir):
    p = tb.preds(spark, sf_dir).where("split = 'val'")
    a = {(r[0], r[1], r[2]): r[3] for r in ev.roc_auc(p, tb.KEYS).collect()}
    q = p.withColumn("score", F.exp(F.col("score") * 3) + 1)
    b = {(r[0], r[1], r[2]): r[3] for r in ev.roc_auc(q, tb.KEYS).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_auc_matches_mann_whitney(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400) * 0.5 + y * 0.3, 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "score": s}))
    auc = ev.roc_auc(df).first()[0]
    ranks = pd.Series(s).rank().to_numpy()
    P, N = y.sum(), len(y) - y.sum()
    mw = (ranks[y == 1].sum() - P * (P + 1) / 2) / (P * N)
    assert abs(auc - mw) < 1e-12


def test_best_threshold_pr_matches_numpy(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.6 + y * 0.2, 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "score": s}))
    got = ev.best_threshold_pr(df).first()
    thr = np.unique(s)
    best = None
    for t in thr:  # ascending, first max wins
        tp = ((s >= t) & (y == 1)).sum(); fp = ((s >= t) & (y == 0)).sum()
        p = tp / (tp + fp); r = tp / y.sum()
        f = 2 * p * r / (p + r + 1e-9)
        if best is None or f > best[0]:
            best = (f, t)
    assert got["threshold"] == round(best[1], 4)


def test_quantile_selection_path_equals_percentile(spark, sf_dir):
    s = tb.study(spark, sf_dir).select("X1", "X2", "X3")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    row = s.agg(*[F.percentile(c, probs).alias(c) for c in ("X1", "X2", "X3")]).first()
    a = {c: row[c] for c in ("X1", "X2", "X3")}
    plain = qt.exact_quantiles(s, ["X1", "X2", "X3"], probs)
    assert all(np.allclose(a[c], plain[c], rtol=0, atol=1e-9) for c in a)
    b = qt.exact_quantiles(s, ["X1", "X2", "X3"], probs, window=20)
    for c in a:
        assert np.allclose(a[c], b[c], rtol=0, atol=1e-9), (c, a[c], b[c])


def test_running_totals_in_blocks(spark):
    """Small range partitions, a NULL group and the form without keys against a plain window."""
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1000).alias("v"),
                                  F.lit(1).cast("bigint").alias("one"))
    for keys in (["g"], []):
        d = df.groupBy(*keys, "v").agg(F.sum("one").alias("one"))
        w = Window.partitionBy(*keys)
        up = w.orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        want = d.select("*", F.sum("one").over(up).alias("cum_one"), F.sum("one").over(w).alias("tot_one")).collect()
        got = running.running_totals(d, keys, "v", ["one"], n_parts=7, totals=True).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == d.count()


def test_class_rank_is_exact_with_buckets(spark, monkeypatch):
    monkeypatch.setattr(sp, "BUCKET_ROWS", 50)
    df = spark.range(3000).select(F.col("id").alias("row_id"), (F.col("id") % 5 == 0).cast("int").alias("y"))
    r = sp.class_rank(df, "y").toPandas()
    for _, g in r.groupby("y"):
        assert sorted(g["_rank"]) == list(range(len(g)))


def test_rows_with_nulls_are_projected_and_resampled(spark, sf_dir):
    from stratum.operators import splits as sp
    from stratum.plans import q_features, q_impute, tables as tb
    study = tb.study(spark, sf_dir)
    train = sp.stratified_split(study, "y").where("split = 'train'")
    smote = q_impute.q_borderline_smote(spark, sf_dir).where("not synthetic").cache()
    pca = q_features.q_pca_2d(spark, sf_dir).cache()
    rows = {"pca": pca.count(), "smote": smote.count()}
    assert rows == {"pca": study.count(), "smote": train.count()}
    assert pca.dropna().count() == rows["pca"] and smote.dropna().count() == rows["smote"]
    assert smote.join(train, "row_id", "left_anti").isEmpty() and pca.join(study, "row_id", "left_anti").isEmpty()


def test_split_is_exact_with_copies_and_null_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 11 != 0, (F.col("id") / 6).cast("long")).alias("row_id"),  # six rows a key
                                  (F.col("id") % 5 == 0).cast("int").alias("y"), "id").repartition(7, "id")
    got = sp.stratified_split(df, "y").collect()
    assert sorted(r.id for r in got) == list(range(3000))
    test, val = sp.split_sizes({c: sum(r.y == c for r in got) for c in (0, 1)})
    for c in (0, 1):
        rows = [r for r in got if r.y == c]
        assert [sum(r.split == s for r in rows) for s in ("test", "val")] == [test[c], val[c]]
        h = {r.row_id: -1 if r.row_id is None else int(hashlib.md5(f"42|{r.row_id}".encode()).hexdigest()[:8], 16) for r in rows}
        want = sorted((h[r.row_id], r.row_id or 0) for r in rows)
        have = [sorted((h[r.row_id], r.row_id or 0) for r in rows if r.split == s) for s in ("test", "val", "train")]
        assert have[0] + have[1] + have[2] == want


def test_split_orders_equal_hashes_by_key(spark, monkeypatch):
    monkeypatch.setattr(sp, "portable_hash", lambda key, seed: (F.col(key) % 2).cast("bigint"))
    got = sp.stratified_split(spark.range(100).select(F.col("id").alias("row_id"), F.lit(1).alias("y")).repartition(3), "y").collect()
    of = lambda s: sorted(r.row_id for r in got if r.split == s)
    assert of("test") == list(range(0, 40, 2)) and of("val") == list(range(40, 80, 2))


def test_split_shuffles_no_rows_and_keeps_their_order(spark, monkeypatch):
    def rank(*a, **k):
        raise AssertionError("ranks all rows")

    monkeypatch.setattr(sp, "class_rank", rank)
    s = sp.stratified_split(spark.range(0, 4000, 1, 4).select(F.col("id").alias("row_id"), (F.col("id") % 7 == 0).cast("int").alias("y")), "y")
    assert s.rdd.getNumPartitions() == 4
    for part in s.withColumn("h", sp.portable_hash("row_id", 42)).rdd.glom().collect():
        assert len(part) == 1000 and [(r.y, r.h) for r in part] == sorted((r.y, r.h) for r in part)


def test_median_takes_three_passes(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_003).cast("double").alias("a"), (F.col("id") % 3).alias("b"),
                                     F.when(F.col("id") % 2 == 0, F.col("id")).alias("c"))
    want = [np.median(x) for x in (np.arange(200_000) * 7919 % 200_003, np.arange(200_000) % 3, np.arange(0, 200_000, 2))]
    calls, agg = [], DataFrame.agg
    monkeypatch.setattr(DataFrame, "agg", lambda *a: calls.append(1) or agg(*a))
    got = qt.exact_quantiles(df, ["a", "b", "c"], [0.5], window=2_000)
    assert [got[c][0] for c in "abc"] == want and len(calls) == 3
    narrow = qt.exact_quantiles(df, ["a", "b", "c"], [0.1, 0.5, 0.9], window=3)
    assert [narrow[c][1] for c in "abc"] == want and narrow["c"][0] == pytest.approx(2 * 0.1 * 99_999)
