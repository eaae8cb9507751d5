"""Literal goldens (FIXTURES §F8)."""
import math

from pyspark.sql import functions as F

from stratum.functions.scalar import gap_status
from stratum.operators import evaluate as ev, splits as sp, features as ft, resample
from stratum.plans import publish as pb


def test_confusion_metrics(spark):
    cc = spark.createDataFrame([(421, 2, 10, 59)], "tn long, fp long, fn long, tp long")
    r = ev.metrics_from_counts(cc).first()
    assert round(r["precision"], 5) == 0.96721
    assert round(r["recall"], 5) == 0.85507
    assert round(r["f1"], 5) == 0.90769


def test_cyclic_extension(spark):
    df = spark.range(492).select((F.col("id") * 10).alias("row_id"), (F.col("id") % 3).alias("pred"))
    out = pb.reconcile_length(df, 820, "cyclic").orderBy("position").collect()
    assert len(out) == 820
    src = {r["row_id"] // 10: r for r in df.collect()}
    for r in out:
        assert r["row_id"] // 10 == r["position"] % 492


def test_split_sizes_golden():
    t, v = sp.split_sizes({0: 2115, 1: 344})
    test, val = sum(t.values()), sum(v.values())
    assert (2459 - test - val, val, test) == (1475, 492, 492)


def test_stratified_split_exact(spark):
    df = spark.range(2459).select(F.col("id").alias("row_id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    s = sp.stratified_split(df, "y")
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert (c["train"], c["val"], c["test"]) == (1475, 492, 492)
    # class share within one row per split
    share = s.groupBy("split").agg(F.avg("y").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    overall = df.agg(F.avg("y")).first()[0]
    for r in share:
        assert abs(r["p"] - overall) * r["n"] <= 1.0 + 1e-9


def test_polynomial_names():
    names = [n for n, _ in ft.polynomial_names(["a", "b", "c"], 2)]
    assert names == ["a", "b", "c", "a^2", "a b", "a c", "b^2", "b c", "c^2"]


def test_gap_status(spark):
    df = spark.createDataFrame([(0.06,), (0.04,), (0.03,), (0.0,)], "gap double")
    assert [r[0] for r in df.select(gap_status(F.col("gap"))).collect()] == ["over", "slight", "good", "good"]


def test_smote_counts(spark):
    # 1269 majority + 206 minority with overlap, ratio 0.8 -> 1015 minority rows
    rows = []
    for i in range(1269):
        rows.append((i, float(i % 97), float((i * 7) % 89), 0))
    for i in range(206):
        rows.append((10000 + i, float((i * 3) % 97) + 0.5, float((i * 11) % 89) + 0.5, 1))
    df = spark.createDataFrame(rows, "row_id long, a double, b double, y int")
    out = resample.borderline_smote(df, ["a", "b"], "y", ratio=0.8, m=10, k=5)
    assert out.where("y = 1").count() == math.floor(0.8 * 1269) == 1015
    assert out.where("y = 0").count() == 1269
