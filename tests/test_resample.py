"""Borderline-SMOTE and k tuning against brute force on small whole tables."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import knn, resample


def points(n=240, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 1)      # many ties
    x[:60] = x[0]                                  # a quarter at one point
    y = ((x[:, 0] + rng.normal(scale=0.7, size=n)) > 0.9).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = points()
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, e double, y int")


FEATS = list("abcde")


def order(x, i, among):
    d = np.sqrt(((x[among] - x[i]) ** 2).sum(axis=1))
    o = np.lexsort((among, d))
    return [int(j) for j in np.asarray(among)[o] if j != i]


def test_synthetic_rows_lie_between_danger_rows_and_their_neighbours(table):
    x, y = points()
    out = resample.borderline_smote(table, FEATS, "y", ratio=0.8, m=10, k=5).collect()
    minority, every = np.flatnonzero(y == 1), np.arange(len(y))
    danger = [i for i in minority if 5 <= sum(y[j] == 0 for j in order(x, i, every)[:10]) < 10]
    near = {i: order(x, i, minority)[:5] for i in danger}
    new = [r for r in out if r.synthetic]
    assert len(new) == int(0.8 * (y == 0).sum()) - len(minority) and len(out) == len(y) + len(new)
    for r in new:
        v = np.array([r[f] for f in FEATS])
        fits = False
        for i in danger:
            for j in near[i]:
                step = x[j] - x[i]
                t = 0.0 if not step.any() else float((v - x[i]) @ step / (step @ step))
                fits |= -1e-9 <= t <= 1 + 1e-9 and np.allclose(x[i] + t * step, v, atol=1e-9)
        assert fits
    assert len({tuple(r[f] for f in FEATS) for r in new}) > len(danger) / 2


def test_many_columns_equal_brute_force(spark):
    """38 features and a target, as in the study: no cell grid could hold them."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 38))
    rows = [(i, *map(float, v), float(i) if i % 4 else None) for i, v in enumerate(x)]
    cols = [f"f{j}" for j in range(38)]
    df = spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} double" for c in cols) + ", t double")
    got = {}
    for r in knn.knn_neighbours(df, [*cols, "t"], 4, cell_rows=20).where("column = 't'").collect():
        got.setdefault(r.row_id, {})[r["rank"]] = r.donor
    donors = [i for i in range(400) if i % 4]
    assert {k: [v[i] for i in sorted(v)] for k, v in got.items()} == {i: order(x, i, np.array(donors))[:4] for i in range(0, 400, 4)}


def test_excluded_rows_never_match(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(300, 2)), 1)
    rows = [(i, float(a), float(b) if i % 3 else None, i % 5) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, f int")
    nb = knn.knn_neighbours(df, ["a", "b"], 3, cell_rows=10, exclude="f").collect()
    got = {}
    for r in nb:
        got.setdefault(r.row_id, {})[r["rank"]] = r.donor
    for i in range(0, 300, 3):
        among = np.array([j for j in range(300) if j % 3 and j % 5 != i % 5])
        d = np.sqrt(2.0 * (x[among, 0] - x[i, 0]) ** 2)
        assert [got[i][n] for n in (1, 2, 3)] == [int(j) for j in among[np.lexsort((among, d))][:3]]


def test_k_tuning_equals_brute_force(spark):
    from stratum.functions.hashing import portable_hash
    rng = np.random.default_rng(7)
    x = rng.normal(size=(150, 3)) @ rng.normal(size=(3, 3))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "row_id long, a double, b double, c double")
    ks, folds, hide = [1, 3, 5, 9], 4, 0.4
    u = [(portable_hash(F.concat(F.col("row_id").cast("string"), F.lit("|" + c)), 42) / F.lit(4294967296.0)).alias(c + "_u") for c in "abc"]
    info = sorted(df.select("row_id", F.pmod(portable_hash("row_id", 42), F.lit(folds)).alias("f"), *u).collect())
    fold = np.array([r.f for r in info])
    gone = np.array([[r.a_u < hide, r.b_u < hide, r.c_u < hide] for r in info])
    want = {k: [] for k in ks}
    for f in range(folds):
        among, errors = np.flatnonzero(fold != f), {k: [] for k in ks}
        for i in np.flatnonzero(fold == f):
            s = ~gone[i]
            d = np.sqrt(3.0 / max(s.sum(), 1) * ((x[among][:, s] - x[i, s]) ** 2).sum(axis=1))
            o = among[np.lexsort((among, d))]
            for j in np.flatnonzero(gone[i]):
                for k in ks:
                    errors[k].append((x[o[:k], j].mean() if s.any() else x[among, j].mean()) - x[i, j])
        for k in ks:
            want[k].append(np.sqrt(np.mean(np.square(errors[k]))))
    got = {r.k: r for r in knn.tune_knn_k(df, list("abc"), ks, folds, hide).collect()}
    for k in ks:
        assert abs(got[k].mean - np.mean(want[k])) < 1e-9 and abs(got[k].std - np.std(want[k])) < 1e-9
    assert [k for k in ks if got[k].best] == [min(ks, key=lambda k: np.mean(want[k]))]
