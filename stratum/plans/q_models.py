"""Catalog entries: models, search, importance, fitted ensembles, scoring (§2.10).
Model fits have no SQL oracle: rows-only checks, plus metric floors in the tests."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import clean, splits as sp, evaluate as ev
from . import tables as tb, models as md
from .catalog import query, R, WITH_STUDY
from .q_clean import _split_sql

FEATS = ["X1", "X2", "X3", "X4", "X5", "X6", "X8", "X9"]
SMALL = {"random_forest": dict(numTrees=20, maxDepth=5), "gradboost": dict(maxIter=10, maxDepth=3),
         "xgboost": dict(maxIter=10, maxDepth=3)}
RFECV_TREES = dict(maxIter=100, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, minInstancesPerNode=5)


def model_data(spark, d):
    """study -> exact stratified split (checkpointed, as fits read it several times) -> medians fitted on train for the nullable columns."""
    s = sp.stratified_split(tb.study(spark, d).select("row_id", *FEATS, "y"), "y")
    med = clean.fit_median(s.where(F.col("split") == "train"), ["X1", "X2", "X3", "X4"])
    return clean.apply_median(s, med)


def _eval_rows(spark, d):
    return model_data(spark, d).where(F.col("split") != "train")


def _fit_predict(data, kind, **params):
    m = md.fit(data.where(F.col("split") == "train"), FEATS, kind, **params)
    return md.predict(m, data.where(F.col("split") != "train"), kind)


@query("train_random_forest")
def q_train_random_forest(spark, d):
    return _fit_predict(model_data(spark, d), "random_forest", **SMALL["random_forest"])


@query("train_gbt")
def q_train_gbt(spark, d):
    data = model_data(spark, d)
    return _fit_predict(data, "gradboost", **SMALL["gradboost"]).unionByName(_fit_predict(data, "xgboost", **SMALL["xgboost"]))


@query("train_linear_svm")
def q_train_linear_svm(spark, d):
    return _fit_predict(model_data(spark, d), "svm", maxIter=50)


@query("train_mlp")
def q_train_mlp(spark, d):
    return _fit_predict(model_data(spark, d), "mlp", hidden=50, maxIter=50)


@query("train_logistic")
def q_train_logistic(spark, d):
    return _fit_predict(model_data(spark, d), "logistic", regParam=0.1)


@query("grid_search_cv")
def q_grid_search_cv(spark, d):
    data = model_data(spark, d).where(F.col("split") == "train")
    _, _, table = md.grid_search_cv(data, FEATS, "random_forest", {"numTrees": [10, 20], "maxDepth": [3, 5]}, folds=3)
    return table


def _sweep(spark, d):
    data = model_data(spark, d)
    plain = data.drop("X8", "X9")
    return md.sweep_models({"median": data, "reduced": plain}, {"median": FEATS, "reduced": [c for c in FEATS if c not in ("X8", "X9")]},
                           ["random_forest", "logistic"], grids={"random_forest": {"maxDepth": [3, 5]}}, fixed={"random_forest": {"numTrees": 20}})


@query("sweep_models")
def q_sweep_models(spark, d):
    return _sweep(spark, d)


@query("generalisation_gap")
def q_generalisation_gap(spark, d):
    return md.generalisation_gap(_sweep(spark, d))


@query("rfecv")
def q_rfecv(spark, d):
    """Every size from all features to one, one feature less each time; five folds, 100 boosted trees of depth 4 (as in the source project)."""
    data = model_data(spark, d).where(F.col("split") == "train")
    _, curve = md.rfecv(data, FEATS, "gradboost", folds=5, step=0.1, **RFECV_TREES)
    return curve


def _rf(data):
    return md.fit(data.where(F.col("split") == "train"), FEATS, "random_forest", scale=False, **SMALL["random_forest"])


@query("feature_importance")
def q_feature_importance(spark, d):
    return md.feature_importance(_rf(model_data(spark, d)), FEATS)


@query("importance_comparison")
def q_importance_comparison(spark, d):
    data = model_data(spark, d)
    gb = md.fit(data.where(F.col("split") == "train"), FEATS, "gradboost", scale=False, **SMALL["gradboost"])
    return md.importance_comparison({"random_forest": md.feature_importance(_rf(data), FEATS),
                                     "gradboost": md.feature_importance(gb, FEATS)}, top=5)


@query("permutation_importance")
def q_permutation_importance(spark, d):
    data = model_data(spark, d)
    return md.permutation_importance(_rf(data), data.where(F.col("split") == "val"), FEATS, repeats=5)


@query("reduced_datasets", R(WITH_STUDY + _split_sql() + """, med AS (SELECT quantile_cont(X1, 0.5) AS m FROM study JOIN splitted USING (row_id) WHERE split = 'train')
SELECT row_id, s.y, split, coalesce(X1, m) AS X1, X5, X8 FROM study s JOIN splitted USING (row_id), med""", ["X1"]))
def q_reduced_datasets(spark, d):
    return md.reduced_datasets(model_data(spark, d), ["X1", "X5", "X8"])


@query("bagging")
def q_bagging(spark, d):
    data = model_data(spark, d)
    return md.bagging(data.where(F.col("split") == "train"), data.where(F.col("split") != "train"), FEATS,
                      "gradboost", n=10, max_features=0.75, maxIter=5, maxDepth=3)


@query("stack_refit")
def q_stack_refit(spark, d):
    data = model_data(spark, d)
    return md.stack_refit(data.where(F.col("split") == "train"), data.where(F.col("split") != "train"), FEATS,
                          ["logistic", "random_forest"], folds=3, params=SMALL)


@query("train_all_ensembles")
def q_train_all_ensembles(spark, d):
    """Soft vote, hard vote, bagging and stacking scored on validation rows; one row each."""
    data = model_data(spark, d)
    tr, val = data.where(F.col("split") == "train"), data.where(F.col("split") == "val")
    return md.train_all_ensembles(tr, val, FEATS, ["random_forest", "logistic"], SMALL, bag=dict(n=2, maxIter=5, maxDepth=3))


@query("ensemble_importance")
def q_ensemble_importance(spark, d):
    data = model_data(spark, d).where(F.col("split") == "train")
    ms = [md.fit(data, FEATS, "gradboost", scale=False, seed=s, maxIter=5, maxDepth=3) for s in (1, 2)]
    return md.ensemble_importance(ms, FEATS, top=8)


@query("score_batch")
def q_score_batch(spark, d):
    data = model_data(spark, d)
    return md.score_batch(_rf(data), data.where(F.col("split") == "test"), FEATS, threshold=0.5)


@query("auto_select_and_score")
def q_auto_select_and_score(spark, d):
    """Champion = best validation F1 of the sweep; refit on train, score the test rows at
    that model's validation-optimal threshold, publish labels."""
    data = model_data(spark, d)
    tr, val, test = (data.where(F.col("split") == s) for s in ("train", "val", "test"))
    kinds = ["random_forest", "logistic"]
    models = {k: md.fit(tr, FEATS, k, **SMALL.get(k, {})) for k in kinds}
    vp = reduce(lambda a, b: a.unionByName(b), [md.predict(m, val, k) for k, m in models.items()])
    th = ev.best_threshold_pr(vp, ["model"])
    return md.auto_select_and_score(test, FEATS, models, th)


@query("smote_cross_validation")
def q_smote_cross_validation(spark, d):
    """Scale, Borderline-SMOTE (0.8 of the majority) and logistic regression, fitted inside each of three folds; held-out F1."""
    data = model_data(spark, d).where(F.col("split") == "train").drop("split")
    scores = md.cross_validate(data, FEATS, "logistic", [{"regParam": 0.01}, {"regParam": 0.1}], folds=3, smote=0.8)
    rows = [(p, f, float(s)) for p, found in zip((0.01, 0.1), scores) for f, s in enumerate(found)]
    return spark.createDataFrame(rows, "reg_param double, fold int, f1 double")
