"""Sparse co-occurrence and phi correlations against dense counts."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import profile, sparse


def matrix(n=600, p=30, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.random((n, p)) < rng.choice([0.001, 0.01, 0.05, 0.5, 0.97], p)
    x[:, 0], x[:, 1] = True, False
    return x


def pairs_of(spark, x):
    rows = [(int(i), f"f{j:03d}") for i, j in zip(*np.nonzero(x))]
    rows += rows[:50] + [(None, "f002"), (1, None)]
    return spark.createDataFrame(rows, "row_id long, feature string")


@pytest.mark.parametrize("rare", [0.0, 1 / 128, 0.1, 1.0])
def test_block_pairs_equal_a_product(rare):
    x = matrix()
    row, feature = np.nonzero(x)
    keys, n = sparse.block_pairs(row, feature, len(x), x.shape[1], rare)
    want = np.triu(x.astype(int).T @ x.astype(int))
    got = np.zeros_like(want)
    got[keys // x.shape[1], keys % x.shape[1]] = n
    assert (got == want).all()


@pytest.mark.parametrize("block", [64, 1 << 14])
def test_cooccurrence_counts(spark, block):
    x = matrix()
    got = {(r.feature_a, r.feature_b): r.n_both for r in sparse.cooccurrence(pairs_of(spark, x).repartition(4), block=block).collect()}
    want = x.astype(int).T @ x.astype(int)
    assert got == {(f"f{i:03d}", f"f{j:03d}"): want[i, j] for i in range(30) for j in range(i, 30) if want[i, j]}


def test_matrix_equals_the_dense_one(spark):
    x = matrix()
    names = [f"f{j:03d}" for j in range(30)]
    wide = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(x)], "row_id long, " + ", ".join(f"{c} int" for c in names))
    got = {(r.col_a, r.col_b): r["corr"] for r in sparse.sparse_correlation_matrix(sparse.to_sparse(wide, names), len(x), names).collect()}
    want = {(r.col_a, r.col_b): r["corr"] for r in profile.correlation_matrix(wide, names).collect()}
    assert got.keys() == want.keys() and len(got) == 30 * 29 // 2
    for k, v in want.items():
        assert (v is None) == (got[k] is None) and (v is None or abs(v - got[k]) < 1e-9)


def test_many_columns_in_one_pass(spark):
    """1,500 columns with a common one: pairs of the common column are bits, not pairs of rows."""
    rng = np.random.default_rng(5)
    rows = [(i, [0, *rng.integers(1, 1500, 8).tolist()]) for i in range(4000)]
    ones = spark.createDataFrame(rows, "row_id long, fs array<long>").select("row_id", F.explode("fs").alias("n")).select("row_id", F.format_string("f%04d", "n").alias("feature"))
    got = {(r.feature_a, r.feature_b): r.n_both for r in sparse.cooccurrence(ones).collect()}
    want = {}
    for _, fs in rows:
        fs = sorted(set(fs))
        for a in range(len(fs)):
            for b in fs[a:]:
                want[fs[a], b] = want.get((fs[a], b), 0) + 1
    assert got == {(f"f{a:04d}", f"f{b:04d}"): n for (a, b), n in want.items()}


def test_no_ones(spark):
    none = spark.createDataFrame([], "row_id long, feature string")
    assert sparse.cooccurrence(none).count() == 0 and sparse.sparse_presence_rates(none, 5).count() == 0
    assert [r["corr"] for r in sparse.sparse_correlation_matrix(none, 5, ["a", "b"]).collect()] == [None]
