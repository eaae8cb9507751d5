"""Permutation importance, frequent null patterns and the smaller study tables against plain loops."""
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import evaluate as ev, profile as pf
from stratum.plans import models as md
from stratum.sources import coerce as co


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 1000, 4097])
def test_feistel_is_a_bijection(n):
    i = np.arange(n)
    a, b = md.feistel(i, n, "a"), md.feistel(i, n, "b")
    assert sorted(a) == list(range(n)) and sorted(b) == list(range(n))
    assert n < 10 or (a != b).mean() > 0.5 and (a != i).mean() > 0.5
    assert (md.feistel(i[::-1].copy(), n, "a")[::-1] == a).all()


def test_permutation_importance(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 3))
    y = (x[:, 0] + 0.3 * x[:, 1] > 0.4).astype(int)
    rows = [(i, *map(float, v), 1.0, int(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, y int")
    feats = list("abcd")
    model = md.fit(df, feats, "logistic", scale=False)
    got = [tuple(r) for r in md.permutation_importance(model, df, feats, repeats=3).collect()]
    drop = {f: m for f, m, _ in got}
    assert drop["a"] > drop["b"] > abs(drop["c"]) - 0.02 and drop["d"] == 0.0 and drop["a"] > 0.2
    again = [tuple(r) for r in md.permutation_importance(model, df.repartition(9), feats, repeats=3).collect()]
    assert [g[0] for g in got] == [g[0] for g in again]
    assert all(abs(p - q) < 1e-12 for g, h in zip(got, again) for p, q in zip(g[1:], h[1:]))
    # the same permutations by hand
    base = ev.basic_metrics(md.predict(model, df, "m", keep=()), [], with_areas=False).first()["f1"]
    from stratum.operators.splits import class_rank
    rank = {r.row_id: r._r for r in class_rank(df.withColumn("_one", F.lit(1)), "_one", "row_id", 42, counts={1: 900}, out="_r").collect()}
    row = {v: k for k, v in rank.items()}
    drops = []
    for repeat in range(3):
        to = md.feistel(np.arange(900), 900, f"42:a:{repeat}")
        swapped = spark.createDataFrame([(i, float(x[row[int(to[rank[i]])], 0]), *map(float, x[i, 1:]), 1.0, int(y[i])) for i in range(900)], df.schema)
        drops.append(base - ev.basic_metrics(md.predict(model, swapped, "m", keep=()), [], with_areas=False).first()["f1"])
    assert abs(np.mean(drops) - drop["a"]) < 1e-9


def test_frequent_patterns_of_a_wide_table(spark):
    """Nearly every row has its own pattern; the common ones are found, exactly, whatever the split."""
    rng = np.random.default_rng(6)
    p = 40
    x = rng.random((3000, p)) < 0.5
    x[rng.random(3000) < 0.06] = False
    x[rng.random(3000) < 0.03, :] = True
    cols = [f"c{j}" for j in range(p)]
    df = spark.createDataFrame([tuple(None if v else 1 for v in r) for r in x], ", ".join(f"{c} int" for c in cols))
    want = Counter("".join("1" if v else "0" for v in r) for r in x)
    for parts in (1, 6):
        got = {r.pattern: r.n_rows for r in pf.frequent_patterns(df.repartition(parts), cols, 0.02).collect()}
        common = {k: v for k, v in want.items() if v >= 60}
        assert len(common) == 2 and got == {**common, None: 3000 - sum(common.values())}
    assert pf.frequent_patterns(df.limit(0), cols).count() == 0
    assert pf.frequent_patterns(df.where("c0 is null and c0 is not null").union(df.limit(1)), cols).count() == 1


def test_normalised_confusion(spark):
    c = spark.createDataFrame([("m", 8, 2, 1, 3), ("n", 0, 0, 0, 5)], "model string, tn long, fp long, fn long, tp long")
    got = {(r.model, r.actual): (r.n_rows, r.predicted_0, r.predicted_1) for r in ev.normalised_confusion(c, ["model"]).collect()}
    assert got == {("m", 0): (10, 0.8, 0.2), ("m", 1): (4, 0.25, 0.75), ("n", 0): (0, 0.0, 0.0), ("n", 1): (5, 0.0, 1.0)}


def test_target_report(spark):
    df = spark.createDataFrame([(i, None if i == 3 else i % 2) for i in range(20)], "row_id long, y int").repartition(4)
    assert tuple(co.target_report(df, "y", "row_id", 5).first()) == ("int", "0,1,0,NULL,0")


def test_correlation_study(spark):
    rng = np.random.default_rng(8)
    b = rng.random((400, 12)) < np.linspace(0.05, 0.6, 12)
    rows = [(float(v[0]) + float(rng.normal()), *map(int, v), int(v[11])) for v in b]
    df = spark.createDataFrame(rows, "x double, " + ", ".join(f"b{j} int" for j in range(12)) + ", y int")
    study = pf.correlation_study(df, ["x"], [f"b{j}" for j in range(12)], "y", per_quartile=2)
    names = [r.column for r in study["ranking"].collect()]
    assert len(names) == 9 and "x" in names
    s = study["summary"].first()
    assert s.n_columns == 9 and s.n_high_pairs == study["pairs"].count()


@pytest.mark.parametrize("n", [1, 2, 10, 1000, 4097])
def test_feistel_inverse(n):
    i = np.arange(n)
    assert (md.feistel(md.feistel(i, n, "a"), n, "a", inverse=True) == i).all()
