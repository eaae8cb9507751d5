"""Model rows: predictions cover the scored rows and clear a metric floor
(the target depends on X5, so any working learner separates the classes)."""
import json

import pytest
from pyspark.sql import functions as F

from stratum.operators import evaluate as ev, splits as sp
from stratum.plans import models as md
from stratum.plans.q_models import model_data, FEATS, SMALL
from stratum.session import scratch_path


@pytest.mark.parametrize("kind", ["random_forest", "gradboost", "logistic", "svm"])
def test_model_auc_floor(spark, sf_dir, kind):
    data = model_data(spark, sf_dir)
    m = md.fit(data.where(F.col("split") == "train"), FEATS, kind, **SMALL.get(kind, {}))
    rows = data.where(F.col("split") != "train")
    p = md.predict(m, rows, kind)
    assert p.count() == rows.count()
    assert ev.roc_auc(p).first()[0] > 0.6


def test_stacking_scores_every_row(spark, sf_dir):
    data = model_data(spark, sf_dir)
    tr, rest = data.where(F.col("split") == "train"), data.where(F.col("split") != "train")
    p = md.stack_refit(tr, rest, FEATS, ["logistic", "random_forest"], folds=3, params=SMALL)
    assert p.count() == rest.count()
    assert p.where(F.col("score").isNull() | (F.col("score") < 0) | (F.col("score") > 1)).count() == 0


def test_svm_is_saved_and_loaded(spark, sf_dir):
    data = model_data(spark, sf_dir).where(F.col("row_id") % 8 == 0)
    m = md.fit(data, FEATS, "svm", maxIter=10, positive_weight=3.0)  # all stages are Spark's own
    path = scratch_path(spark, "svm-model")
    md.save_model(m, path)
    a, b = (sorted(tuple(r) for r in md.predict(x, data, "svm").select("row_id", "score").collect()) for x in (m, md.load_model(path)))
    assert a == b


def test_cross_validation_never_validates_on_synthetic_rows(spark, sf_dir, monkeypatch):
    data = model_data(spark, sf_dir).where(F.col("split") == "train").select("row_id", "X1", "X5", "y").where(F.col("row_id") % 6 == 0)
    seen = []
    real = md.predict

    def predict(model, df, *a, **k):
        seen.append((df.count(), df.where("row_id < 0").count()))
        return real(model, df, *a, **k)

    monkeypatch.setattr(md, "predict", predict)
    scores = md.cross_validate(data, ["X1", "X5"], "logistic", [{}], folds=2, smote=0.8)
    assert len(scores[0]) == 2 and all(0 <= s <= 1 for s in scores[0])
    assert sum(n for n, _ in seen) == data.count() and all(syn == 0 for _, syn in seen)


def test_bootstrap_draws_do_not_depend_on_partitions(spark, sf_dir):
    data = model_data(spark, sf_dir).where(F.col("row_id") % 12 == 0)
    a, b = ({r.row_id: round(r.score, 9) for r in md.bagging(d, data, FEATS, "logistic", n=2, max_features=0.5).collect()}
            for d in (data.repartition(1), data.repartition(5)))
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-4
    s = sp.sample_rows(data, 50, with_replacement=True)
    assert s.count() == 50 and s.columns == data.columns


def test_auto_select_prefers_the_better_source(spark, sf_dir):
    data = model_data(spark, sf_dir).where(F.col("row_id") % 15 == 0)
    models = {"logistic": md.fit(data, FEATS, "logistic")}
    table = spark.createDataFrame([("logistic", 0.4, 0.8)], "model string, threshold double, f1 double")
    got = md.auto_select_and_score(data, FEATS, models, table)
    assert got.count() == data.count() and {r.model for r in got.collect()} == {"logistic"}
    path = scratch_path(spark, "champion-docs")
    spark.createDataFrame([(json.dumps({"method": "stack", "threshold": 0.5, "performance": {"f1_score_test": 0.9},
                                        "predictions": {"test": [0.1, 0.9, 0.7]}}),)], "value string").write.text(path)
    rows = md.auto_select_and_score(data.limit(3), FEATS, models, table.withColumn("f1", F.lit(0.2)), path).orderBy("row_id").collect()
    assert [r.pred for r in rows] == [0, 1, 1] and {r.model for r in rows} == {"stack"}


def _two_useful_columns(spark, n=400):
    """y follows a and b; c and d are noise."""
    u = lambda k: (F.abs(F.xxhash64(F.lit(k), "id")) % 1000) / 1000
    return (spark.range(n).select(F.col("id").alias("row_id"), *[u(k).alias(k) for k in "abcd"])
            .withColumn("y", (F.col("a") + F.col("b") > 1).cast("int")))


def test_rfecv_drops_the_least_important(spark):
    df = _two_useful_columns(spark)
    best, curve = md.rfecv(df, list("abcd"), "random_forest", folds=2, step=0.3, min_features=2, numTrees=10, maxDepth=4)
    rows = {r.n_features: r for r in curve.collect()}
    assert sorted(rows) == [2, 3, 4]
    assert rows[2].features.split(",") == ["a", "b"] and set(rows[3].features.split(",")) > {"a", "b"}
    assert best == max(rows.values(), key=lambda r: (r.f1_mean, -r.n_features)).features.split(",")
    # the score of one size from the folds by hand
    folds = sp.stratified_folds(df, "y", 2, "row_id", 42)
    f1 = []
    for f in (0, 1):
        m = md.fit(folds.where(F.col("fold") != f), ["a", "b"], "random_forest", scale=False, numTrees=10, maxDepth=4)
        got = [(r.y, int(r.score >= 0.5)) for r in md.predict(m, folds.where(F.col("fold") == f), "m").collect()]
        tp, wrong = sum(y and p for y, p in got), sum(y != p for y, p in got)
        f1.append(2 * tp / (2 * tp + wrong))
    assert rows[2].f1_mean == pytest.approx(sum(f1) / 2, abs=0.03)  # forests draw their own samples


def test_mlp_learns(spark):
    df = _two_useful_columns(spark)
    m = md.fit(df.where("row_id < 300"), list("abcd"), "mlp", hidden=8, maxIter=60)
    p = md.predict(m, df.where("row_id >= 300"), "mlp")
    assert p.count() == 100 and ev.roc_auc(p).first()[0] > 0.95


def test_rfecv_query_visits_every_size_with_whole_models(spark, sf_dir, monkeypatch):
    from stratum.plans import q_models
    tried, real = [], md.fit

    def fit(df, feats, kind, *a, **k):
        tried.append((kind, len(feats), k["maxIter"], k["maxDepth"]))
        return real(df, feats, kind, *a, **{**k, "maxIter": 1, "maxDepth": 2})

    monkeypatch.setattr(md, "fit", fit)
    curve = q_models.q_rfecv(spark, sf_dir).collect()
    assert [r.n_features for r in curve] == list(range(len(FEATS), 0, -1))  # no size is left out
    sizes = [n for _, n, _, _ in tried]
    assert all(sizes.count(n) == (6 if n > 1 else 5) for n in range(1, len(FEATS) + 1))  # five folds and the ranking
    assert {(k, i, depth) for k, _, i, depth in tried} == {("gradboost", 100, 4)}


def _recorded_fits(monkeypatch):
    seen, real = [], md.fit

    def fit(df, feats, kind, *a, **k):
        seen.append((kind, df.storageLevel.useMemory))
        return real(df, feats, kind, *a, **k)

    monkeypatch.setattr(md, "fit", fit)
    return seen


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bagging_scores_all_members_in_one_pass(spark, monkeypatch):
    df = _two_useful_columns(spark, 300).checkpoint()
    rows = df.unionByName(df.where("row_id < 20").withColumn("a", F.lit(0.5))).checkpoint()  # keys that repeat get one mean
    members, real = [], md.fit
    monkeypatch.setattr(md, "fit", lambda *a, **k: members.append(real(*a, **k)) or members[-1])
    got = md.bagging(df, rows, list("abcd"), "logistic", n=3)
    assert _plan(got).count("Scan ExistingRDD") == 1
    want = {}
    for m in members:
        for r in md.predict(m, rows, "m").collect():
            want.setdefault(r.row_id, []).append(r.score)
    found = {r.row_id: r.score for r in got.collect()}
    assert found == pytest.approx({k: sum(v) / len(v) for k, v in want.items()})


def test_bootstrap_copies_hash_a_row_once(spark, monkeypatch):
    df = _two_useful_columns(spark, 2000)
    samples, real = [], md.fit
    monkeypatch.setattr(md, "fit", lambda df, *a, **k: samples.append(df) or real(df, *a, **k))
    md.bagging(df, df, list("abcd"), "logistic", n=1)
    assert samples[0]._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    # Poisson quantiles of the same hashes
    from stratum.functions.hashing import uniform
    u = {r.row_id: r.u for r in df.select("row_id", uniform("row_id", "42:0").alias("u")).collect()}
    copies = {r.row_id: r["count"] for r in samples[0].groupBy("row_id").count().collect()}
    e = 2.718281828459045
    below = [1 / e, 2 / e, 2.5 / e, (2.5 + 1 / 6) / e, (2.5 + 1 / 6 + 1 / 24) / e]
    assert all(copies.get(k, 0) == sum(x >= b for b in below) for k, x in u.items() if x < below[-1])


def test_stacking_shuffles_one_row_a_key(spark):
    df = _two_useful_columns(spark).checkpoint()
    got = md.stack_refit(df.where("row_id < 300"), df.where("row_id >= 300"), list("abcd"), ["logistic", "svm"], folds=2, params={"svm": {"maxIter": 5}})
    plan = _plan(got)
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Aggregate(key") == 2  # before and after the shuffle
    assert got.count() == 100


def test_all_ensembles_fit_no_base_twice(spark, monkeypatch):
    df = _two_useful_columns(spark).checkpoint()
    seen = _recorded_fits(monkeypatch)
    got = md.train_all_ensembles(df.where("row_id < 300"), df.where("row_id >= 300"), list("abcd"), ["logistic", "random_forest"],
                                 {"random_forest": dict(numTrees=5, maxDepth=3)}, folds=2, bag=dict(kind="svm", n=2, maxIter=5))
    assert {r.ensemble for r in got.collect()} == {"soft_vote", "hard_vote", "bagging", "stacking"}
    kinds = [k for k, _ in seen]
    assert kinds.count("random_forest") == 3 and kinds.count("svm") == 2 and kinds.count("logistic") == 4  # one a fold, one on all rows


def test_sweep_makes_the_folds_of_a_dataset_once(spark, monkeypatch):
    df = _two_useful_columns(spark).withColumn("split", F.when(F.col("row_id") < 300, "train").otherwise("val")).checkpoint()
    made, real = [], md.stratified_folds
    monkeypatch.setattr(md, "stratified_folds", lambda *a, **k: made.append(1) or real(*a, **k))
    grids = {"random_forest": {"maxDepth": [2, 3]}}
    got = {r.model: r for r in md.sweep_models({"all": df}, {"all": list("abcd")}, ["logistic", "random_forest"], grids, folds=2,
                                               fixed={"random_forest": {"numTrees": 5}}).collect()}
    assert len(made) == 1
    train = df.where("split = 'train'")
    one = md.cross_validate(train, list("abcd"), "logistic", [{}], folds=2)
    two = md.cross_validate(train, list("abcd"), "random_forest", [{"numTrees": 5, "maxDepth": d} for d in (2, 3)], folds=2)
    assert got["logistic"].f1_cv == pytest.approx(sum(one[0]) / 2)
    assert got["random_forest"].f1_cv == pytest.approx(max(sum(x) / 2 for x in two))


def test_points_of_a_grid_share_the_rows_of_a_fold(spark, monkeypatch):
    df = _two_useful_columns(spark).checkpoint()
    seen, before = _recorded_fits(monkeypatch), set(spark.sparkContext._jsc.getPersistentRDDs())
    md.grid_search_cv(df, list("abcd"), "logistic", {"regParam": [0.0, 0.1]}, folds=2)
    assert [held for _, held in seen] == [True] * 4 + [False]
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before
