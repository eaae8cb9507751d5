"""Binned threshold grids, weight search by blocks and power-transform moments against plain loops."""
import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from stratum.operators import evaluate as ev, transform as tf
from stratum.plans import ensembles as en


def test_grid_counts_equal_a_loop(spark):
    rng = np.random.default_rng(1)
    rows = [(["a", "b", None][i % 3], int(rng.random() < 0.3), None if i % 17 == 0 else float(np.round(rng.random(), 2))) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, y int, score double")
    cuts = [0.5, 0.1, 0.25, 0.9, 0.25, 0.0, 1.5]
    got = {(r.g, r.grid_idx): (r.threshold, r.tp, r.fp, r.fn, r.tn) for r in ev.threshold_sensitivity(df, ["g"], thresholds=cuts).collect()}
    for g in ("a", "b", None):
        for i, t in enumerate(cuts):
            mine = [(y, s is not None and s >= t) for k, y, s in rows if k == g]
            assert got[g, i] == (t, *(sum(1 for y, p in mine if (y == a) and p == b) for a, b in ((1, True), (0, True), (1, False), (0, False))))
    assert len(got) == 21
    plan = ev.threshold_sensitivity(df, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    alone = ev.threshold_sensitivity(df, thresholds=[0.5]).first()
    assert alone.tp == sum(1 for _, y, s in rows if y == 1 and s is not None and s >= 0.5)
    assert ev.threshold_sensitivity(df.limit(0), ["g"]).count() == 0


def test_weight_search_equals_a_loop(spark):
    rng = np.random.default_rng(2)
    models, rows, scores = ["p", "q", "r"], [], {}
    for i in range(300):
        y, g = int(rng.random() < 0.4), i % 2
        for m in models:
            if not (i % 29 == 0 and m == "q"):
                scores[i, m] = float(np.round(rng.random(), 1))
                rows.append((i, g, m, y, scores[i, m]))
    df = spark.createDataFrame(rows, "row_id long, g int, model string, y int, score double")
    label = {r[0]: r[3] for r in rows}
    got = {(r.g, r.w_p, r.w_q, r.w_r): r.f1 for r in en.optimise_ensemble(df, models, ["g"], (1, 2)).collect()}
    assert len(got) == 16
    for g in (0, 1):
        for ws in itertools.product((1.0, 2.0), repeat=3):
            c = {(a, b): 0 for a in (0, 1) for b in (False, True)}
            for i in range(g, 300, 2):
                if i % 29:
                    num = 0.0
                    for w, m in zip(ws, models):
                        num += w * scores[i, m]
                    c[label[i], num / sum(ws) >= 0.5] += 1
            f1 = 2 * c[1, True] / (2 * c[1, True] + c[0, True] + c[1, False])
            assert abs(got[(g, *ws)] - f1) < 1e-12


def test_lambda_is_the_best_of_the_fine_grid(spark):
    rng = np.random.default_rng(3)
    x = {"a": rng.lognormal(size=500), "b": rng.normal(size=500) * 2, "c": np.full(500, 2.0)}
    rows = [tuple(None if i % 11 == 0 else float(x[c][i]) for c in "abc") for i in range(500)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(7)

    def likelihood(v, lam, method):
        if method == "box-cox":
            t, j = (np.log(v) if abs(lam) < 1e-12 else (v ** lam - 1) / lam), np.log(v)
        else:
            pos = v >= 0
            t = np.empty_like(v)
            t[pos] = np.log(v[pos] + 1) if abs(lam) < 1e-12 else ((v[pos] + 1) ** lam - 1) / lam
            t[~pos] = -np.log(1 - v[~pos]) if abs(lam - 2) < 1e-12 else -((1 - v[~pos]) ** (2 - lam) - 1) / (2 - lam)
            j = np.sign(v) * np.log(np.abs(v) + 1)
        return -len(v) / 2 * math.log(t.var()) + (lam - 1) * j.sum()

    for method, cols in (("yeo-johnson", ["a", "b"]), ("box-cox", ["a"])):
        params = {(r.column, r.param): r.value for r in tf.fit_power(df, [*cols, "c"], method).collect()}
        for c in cols:
            v = np.array([x[c][i] for i in range(500) if i % 11])
            best = params[c, "lambda"]
            near = [best + k * 0.001 for k in range(-10, 11)]
            assert max(near, key=lambda lam: likelihood(v, lam, method)) == best
        assert params["c", "lambda"] is None  # constant


def test_choose_transform_takes_the_smaller_skewness(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.lognormal(size=800), rng.normal(size=800) + 9)], "a double, b double")
    for r in tf.choose_transform(df, ["a", "b"]).collect():
        smaller = "yeo-johnson" if abs(r.skew_yeo_johnson) <= abs(r.skew_box_cox) else "box-cox"
        assert r.method == smaller and min(abs(r.skew_yeo_johnson), abs(r.skew_box_cox)) <= abs(r.skew_before) + 1e-9
