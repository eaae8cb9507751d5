"""Many equal rows: k-NN keeps k of them; models read checkpointed rows."""
import contextlib
import io

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from stratum.operators import knn
from stratum.plans import q_models as qm


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _copies(spark, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(60, 3)) * 4) / 4  # distances without rounding
    x[rng.random((60, 3)) < 0.3] = np.nan
    x = np.tile(x, (9, 1))
    ids = rng.permutation(len(x))
    pdf = pd.DataFrame(x, columns=list("abc"))
    pdf.insert(0, "row_id", ids)
    df = spark.createDataFrame(pdf).select("row_id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    return x[np.argsort(ids)], df


def _nearest(x, i, j, k):
    common = ~np.isnan(x) & ~np.isnan(x[i])
    n = common.sum(1)
    d = np.sqrt(3 / np.maximum(n, 1) * (np.where(common, x - x[i], 0.0) ** 2).sum(1))
    ok = np.flatnonzero((n > 0) & ~np.isnan(x[:, j]))
    return list(ok[np.lexsort((ok, d[ok]))][:k])


def test_copies_give_the_smallest_keys(spark):
    x, df = _copies(spark)
    nb = knn.knn_neighbours(df, list("abc"), k=5, cell_rows=8).toPandas()
    fill = knn.knn_fill(df, list("abc"), k=5, cell_rows=8).toPandas().set_index("row_id")
    for (i, c), g in nb.groupby(["row_id", "column"]):
        j = "abc".index(c)
        want = _nearest(x, i, j, 5)
        assert list(g.sort_values("rank")["donor"]) == want
        assert abs(fill.loc[i, c] - x[want, j].mean()) < 1e-9
    assert nb["row_id"].nunique() == len(fill)


def test_donors_of_one_row_stop_at_k():
    ids = [np.array([7, 9]), np.array([1, 8]), np.array([2, 3])]
    i, j, d = np.array([0, 0, 0]), np.array([1, 0, 2]), np.array([0.5, 0.5, 2.0])
    found = knn.nearest_donors(i, j, d, ids, 3)
    assert found[2].tolist() == [1, 7, 8] and found[1].tolist() == [1, 0, 1]


def test_model_rows_are_read_once(spark):
    plan = _plan(qm.model_data(spark, "/root/testdata/sf0.001"))
    assert "parquet" not in plan and "Window" not in plan and "Exchange" not in plan
