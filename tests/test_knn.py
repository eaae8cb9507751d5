"""Grid k-NN join equals brute force; imputation uses the mean of the k donors."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stratum.operators.knn import knn_neighbours, impute_knn


def _data(spark, n=800, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.lognormal(size=(n, 3))
    X[:, 2] = np.round(X[:, 2])           # ties on a discrete column
    X[rng.random((n, 3)) < 0.25] = np.nan
    pdf = pd.DataFrame(X, columns=list("abc"))
    pdf.insert(0, "row_id", np.arange(n))
    df = spark.createDataFrame(pdf).select("row_id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    return X, df


def _brute(X, rid, cj, k):
    p = X.shape[1]
    a = X[rid]
    don = np.where(~np.isnan(X[:, cj]))[0]
    common = ~np.isnan(X[don]) & ~np.isnan(a)
    cnt = common.sum(1)
    diff = np.where(common, X[don] - a, 0.0)
    d = np.sqrt(p / np.maximum(cnt, 1) * (diff ** 2).sum(1))
    d[cnt == 0] = np.inf
    o = np.lexsort((don, d))
    return [int(x) for x in don[o][:k] if np.isfinite(d[o][list(don[o]).index(x)])]


def test_neighbours_equal_brute_force(spark):
    X, df = _data(spark)
    nb = knn_neighbours(df, list("abc"), k=4, cell_rows=8).toPandas()
    cols = list("abc")
    for (rid, col), g in nb.groupby(["row_id", "column"]):
        assert list(g.sort_values("rank")["donor"]) == _brute(X, rid, cols.index(col), 4)


def test_impute_knn_means(spark):
    X, df = _data(spark, 400, 3)
    out = impute_knn(df, list("abc"), k=3).toPandas().set_index("row_id")
    for rid in range(0, 400, 7):
        for j, c in enumerate("abc"):
            if np.isnan(X[rid, j]):
                nbrs = _brute(X, rid, j, 3)
                exp = np.mean(X[nbrs, j]) if nbrs else np.nanmean(X[:, j])
                assert abs(out.loc[rid, c] - exp) < 1e-9
            else:
                assert out.loc[rid, c] == X[rid, j]
