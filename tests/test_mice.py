"""MICE on null patterns against the chain on rows; row numbers."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import mice, project


def chain(x, alpha=1e-3, rounds=10, tol=1e-3):
    """The row-wise chain: normal equations over the rows where a column is known, in every round."""
    gone = np.isnan(x)
    n, p = x.shape
    scale = np.nanmax(np.abs(x))
    cur = np.where(gone, np.nanmean(x, axis=0), x)
    order = sorted((j for j in range(p) if gone[:, j].any()), key=lambda j: (gone[:, j].sum(), j))
    done = 0
    for _ in range(rounds):
        done, old = done + 1, cur.copy()
        for j in order:
            z = np.column_stack([np.ones(n), np.delete(cur, j, axis=1)])
            known = ~gone[:, j]
            reg = alpha * np.eye(p)
            reg[0, 0] = 0
            beta = np.linalg.lstsq(z[known].T @ z[known] + reg, z[known].T @ cur[known, j], rcond=None)[0]
            cur[gone[:, j], j] = z[gone[:, j]] @ beta
        if np.abs(cur - old).max() < tol * scale:
            break
    return cur, done


def frame(spark, x):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, " + ", ".join(f"c{j} double" for j in range(x.shape[1]))).withColumn("note", F.lit("n"))


def data(n=400, p=5, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, p)) + 0.3 * rng.normal(size=(n, p)) + np.arange(p) * 10
    x[rng.random((n, p)) < 0.2] = np.nan
    x[:, p - 1] = np.where(np.isnan(x[:, p - 1]), 7.0, x[:, p - 1])  # a whole column
    x[5, :] = np.nan
    x[5, p - 1] = 3.0
    return x


@pytest.mark.parametrize("rounds,tol", [(1, 0.0), (4, 0.0), (10, 1e-3)])
def test_mice_equals_the_chain_on_rows(spark, rounds, tol):
    x = data()
    cols = [f"c{j}" for j in range(x.shape[1])]
    out, params = mice.impute_mice(frame(spark, x).repartition(5), cols, max_iter=rounds, tol=tol, return_params=True)
    want, done = chain(x, rounds=rounds, tol=tol)
    got = np.array([[r[c] for c in cols] for r in out.orderBy("row_id").collect()])
    assert np.abs(got - want).max() < 1e-6
    assert out.columns == ["row_id", *cols, "note"]
    told = {r.value for r in params.where("param = 'rounds'").collect()}
    assert told == {float(done)}
    again = np.array([[r[c] for c in cols] for r in mice.apply_mice(frame(spark, x), params).orderBy("row_id").collect()])
    assert np.isfinite(again).all() and (np.abs(again - x)[~np.isnan(x)] == 0).all()


def test_mice_needs_complete_rows(spark):
    with pytest.raises(mice.ImputationError):
        mice.impute_mice(frame(spark, np.full((20, 2), np.nan)), ["c0", "c1"])
    with pytest.raises(mice.ImputationError):
        mice.impute_mice(frame(spark, data()).limit(0), ["c0", "c1"])
    whole = frame(spark, np.ones((20, 2)))
    assert mice.impute_mice(whole, ["c0", "c1"]).count() == 20


def test_row_numbers(spark):
    df = spark.range(0, 1000, 1, 7).withColumnRenamed("id", "v").withColumn("row_id", F.lit(5))
    got = project.attach_row_id(df.where("v % 3 > 0"))
    rows = got.collect()
    assert got.columns == ["v", "row_id"] and sorted(r.row_id for r in rows) == list(range(len(rows)))
    assert [r.v for r in sorted(rows, key=lambda r: r.row_id)] == sorted(r.v for r in rows)
    assert "Python" not in got._jdf.queryExecution().toString()
    assert project.attach_row_id(df.limit(0)).count() == 0
