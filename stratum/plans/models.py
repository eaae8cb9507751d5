"""Model training, search, selection and importance on ``pyspark.ml`` (distributed fits).

Data contract: one DataFrame with ``row_id``, feature columns, label ``y`` and ``split``
(train/val/test) or ``fold``. Predictions come out in the long form
``(row_id, model, split, y, score)`` that every evaluation operator consumes.
Gaps to the source project's engines (documented): no L1/L2 leaf penalties for boosted
trees, MLP hidden layers use sigmoid without L2, SVM is linear with Platt scaling.
"""
from __future__ import annotations

import hashlib
import itertools
import json
import math
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import uniform
from ..functions.scalar import qcol
from ..operators import clean
from ..operators.splits import stratified_folds
from ..session import cut_lineage, ship

FEATURES_COL = "_features"
#: Up to so many rows the fits of one step of ``rfecv`` run side by side; more rows keep the cores busy by themselves.
SIDE_BY_SIDE_ROWS = 1_000_000


def assembler(feats: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=feats, outputCol=FEATURES_COL, handleInvalid="keep")


def estimator(kind: str, label: str = "y", seed: int = 42, **params):
    """``random_forest`` | ``gradboost`` | ``xgboost`` | ``svm`` | ``mlp`` | ``logistic``."""
    common = dict(featuresCol=FEATURES_COL, labelCol=label)
    if kind == "random_forest":
        p = dict(numTrees=100, maxDepth=8, minInstancesPerNode=1, featureSubsetStrategy="sqrt", seed=seed)
        p.update(params)
        return RandomForestClassifier(**common, **p)
    if kind in ("gradboost", "xgboost"):
        p = dict(maxIter=50, maxDepth=4, stepSize=0.1, seed=seed)
        if kind == "xgboost":   # column and row sampling as in the boosted-tree preset
            p.update(subsamplingRate=0.8, featureSubsetStrategy="0.8")
        p.update(params)
        return GBTClassifier(**common, **p)
    if kind == "svm":
        p = dict(maxIter=100, regParam=0.01)
        p.update(params)
        return LinearSVC(**common, **p)
    if kind == "mlp":
        n_in = params.pop("n_features")
        hidden = params.pop("hidden", 50)
        p = dict(maxIter=200, seed=seed, solver="l-bfgs", layers=[n_in, hidden, 2])
        p.update(params)
        return MultilayerPerceptronClassifier(**common, **p)
    if kind == "logistic":
        p = dict(maxIter=100, regParam=0.0)
        p.update(params)
        return LogisticRegression(**common, **p)
    raise ValueError(f"unknown model kind {kind!r}")


def fit(df: DataFrame, feats: list[str], kind: str, label: str = "y", scale: bool = True,
        positive_weight: float | None = None, **params) -> PipelineModel:
    """assemble -> (scale by population-free std, no centring) -> classifier; SVM adds Platt.

    ``positive_weight``: weight of the rows of class 1 (not for ``mlp``). All stages can be saved."""
    if positive_weight is not None:
        df = df.withColumn("_weight", F.when(qcol(label) == 1, F.lit(float(positive_weight))).otherwise(1.0))
        params["weightCol"] = "_weight"
    stages = [assembler(feats)]
    if scale:
        stages = [VectorAssembler(inputCols=feats, outputCol="_raw", handleInvalid="keep"),
                  StandardScaler(inputCol="_raw", outputCol=FEATURES_COL, withMean=False, withStd=True)]
    if kind == "mlp":
        params.setdefault("n_features", len(feats))
    stages.append(estimator(kind, label, **params))
    model = Pipeline(stages=stages).fit(df)
    if kind == "svm":   # Platt scaling: logistic regression on the margin
        platt = LogisticRegression(featuresCol="rawPrediction", labelCol=label, regParam=0.0, predictionCol="_pp",
                                   probabilityCol="_platt_prob", rawPredictionCol="_praw").fit(model.transform(df).select(label, "rawPrediction"))
        model = PipelineModel(stages=[*model.stages, platt])
    return model


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model, df: DataFrame, name: str, key: str = "row_id", label: str = "y",
            keep=("split",)) -> DataFrame:
    """Long predictions ``(row_id, model, [split], y, score)``; score = P(class 1)."""
    out = model.transform(df)
    prob = F.col("_platt_prob") if "_platt_prob" in out.columns else F.col("probability")
    return out.select(qcol(key), F.lit(name).alias("model"), *[qcol(k) for k in keep if k in df.columns],
                      qcol(label), vector_to_array(prob)[1].alias("score"))


def score_columns(models: dict[str, PipelineModel], df: DataFrame, key: str = "row_id", label: str = "y", keep=("split",)) -> DataFrame:
    """The scores of ``predict`` as one column per model (named as in ``models``): one pass, one row per row of ``df``."""
    out, names = df, {n: f"_score{i}" for i, n in enumerate(models)}
    for n, model in models.items():
        scored = model.transform(out)
        prob = F.col("_platt_prob") if "_platt_prob" in scored.columns else F.col("probability")
        out = scored.select(*[qcol(c) for c in out.columns], vector_to_array(prob)[1].alias(names[n]))
    return out.select(qcol(key), *[qcol(k) for k in keep if k in df.columns], qcol(label), *[F.col(c).alias(n) for n, c in names.items()])


# ------------------------------------------------------------------ search
def cross_validate(df: DataFrame, feats: list[str], kind: str, points: list[dict], folds: int = 5, label: str = "y",
                   key: str = "row_id", seed: int = 42, scale: bool = True, smote: float | None = None,
                   positive_weight: float | None = None) -> list[list[float]]:
    """F1 of class 1 per grid point and stratified fold: scale -> (Borderline-SMOTE) -> classifier, fitted on
    the other folds only. ``smote``: minority share of the majority; synthetic rows are never validated on."""
    return _fold_scores(df, feats, [(kind, p) for p in points], folds, label, key, seed, scale, smote, positive_weight)


def _fold_scores(df: DataFrame, feats: list[str], candidates: list[tuple[str, dict]], folds: int = 5, label: str = "y", key: str = "row_id",
                 seed: int = 42, scale: bool = True, smote: float | None = None, positive_weight: float | None = None) -> list[list[float]]:
    """``cross_validate`` of (kind, parameters) candidates: the folds, and what is made of a fold, are made once for all."""
    from ..operators import evaluate as ev
    from ..operators.resample import borderline_smote
    data = stratified_folds(df.select(key, *feats, label), label, folds, key, seed)
    scores: list[list[float]] = [[] for _ in candidates]
    for f in range(folds):
        train, held = data.where(F.col("fold") != f).drop("fold"), data.where(F.col("fold") == f)
        if smote is not None:
            if scale:  # neighbours are those of the scaled features
                params = clean.fit_scale_std(train, feats)
                train, held = (clean.apply_scale_std(x, params) for x in (train, held))
            train = cut_lineage(borderline_smote(train, feats, label, smote, key=key, seed=seed))
        kept = train.select(*feats, label).persist(StorageLevel.MEMORY_AND_DISK) if len(candidates) > 1 else train
        for i, (kind, p) in enumerate(candidates):
            m = fit(kept, feats, kind, label, scale and smote is None, positive_weight, **p)
            pred = predict(m, held, kind, key, label, keep=())
            scores[i].append(ev.basic_metrics(pred, [], label, "score", 0.5, with_areas=False).first()["f1"])
        if kept is not train:
            kept.unpersist()
    return scores


def _points(grid: dict) -> list[dict]:
    return [dict(zip(grid, v)) for v in itertools.product(*grid.values())]


def grid_search_cv(df: DataFrame, feats: list[str], kind: str, grid: dict, folds: int = 5, label: str = "y",
                   key: str = "row_id", seed: int = 42, fixed: dict | None = None, scores: list[list[float]] | None = None, **how):
    """Exhaustive grid, mean positive-class F1 over stratified folds, refit of the best on all rows.

    ``fixed``: parameters of every point; ``how``: ``scale``, ``smote`` and ``positive_weight`` as in ``cross_validate``;
    ``scores``: those of ``cross_validate``, if the caller has them.
    Returns (best model, best params dict, per-point table DataFrame)."""
    points = _points(grid)
    scores = scores or cross_validate(df, feats, kind, [{**(fixed or {}), **p} for p in points], folds, label, key, seed, **how)
    means = [sum(x) / len(x) for x in scores]
    best = max(range(len(points)), key=lambda i: (means[i], -i))
    rows = [(kind, json.dumps(p, sort_keys=True), float(m), i == best) for i, (p, m) in enumerate(zip(points, means))]
    table = df.sparkSession.createDataFrame(rows, "model string, params string, f1_cv double, best boolean")
    train, scale, smote = df.select(key, *feats, label), how.get("scale", True), how.get("smote")
    if smote is not None:
        from ..operators.resample import borderline_smote
        train = cut_lineage(borderline_smote(train, feats, label, smote, key=key, seed=seed))
    model = fit(train, feats, kind, label, scale, how.get("positive_weight"), **{**(fixed or {}), **points[best]})
    return model, points[best], table


def sweep_models(datasets: dict[str, DataFrame], feats: dict[str, list[str]], kinds: list[str], grids: dict[str, dict] | None = None,
                 folds: int = 3, label: str = "y", fixed: dict[str, dict] | None = None, **how) -> DataFrame:
    """Every model x dataset: CV F1 on train (one point without a grid), then metrics on validation at 0.5:
    ``model, dataset, f1_cv, f1_val, precision, recall, auc, f1_weighted, gap, best_params``."""
    from ..operators import evaluate as ev
    out = []
    for dname, df in datasets.items():
        train, val = df.where(F.col("split") == "train"), df.where(F.col("split") == "val")
        tried = [(kind, p) for kind in kinds for p in _points((grids or {}).get(kind) or {})]
        scores = _fold_scores(train, feats[dname], [(kind, {**((fixed or {}).get(kind) or {}), **p}) for kind, p in tried], folds, label, **how)
        for kind in kinds:
            model, best, table = grid_search_cv(train, feats[dname], kind, (grids or {}).get(kind) or {}, folds, label, fixed=(fixed or {}).get(kind),
                                                scores=[x for (k, _), x in zip(tried, scores) if k == kind], **how)
            f1_cv = table.where("best").select("f1_cv").first()[0]
            p = cut_lineage(predict(model, val, kind))
            m = ev.basic_metrics(p, [], label, "score", 0.5)
            w = ev.class_report(ev.with_prediction(p, 0.5), [], label, "pred").where(F.col("label") == "weighted avg")
            row = m.withColumn("_k", F.lit(1)).join(w.select(F.col("f1").alias("f1_weighted")).withColumn("_k", F.lit(1)), "_k")
            out.append(row.select(F.lit(kind).alias("model"), F.lit(dname).alias("dataset"), F.lit(f1_cv).cast("double").alias("f1_cv"),
                                  F.col("f1").alias("f1_val"), "precision", "recall", F.col("auc_roc").alias("auc"), "f1_weighted",
                                  F.lit(json.dumps(best, sort_keys=True)).alias("best_params")))
    res = reduce(lambda a, b: a.unionByName(b), out)
    return res.withColumn("gap", F.col("f1_cv") - F.col("f1_val"))


def generalisation_gap(results: DataFrame, cv: str = "f1_cv", val: str = "f1_val") -> DataFrame:
    from ..functions.scalar import gap_status
    g = F.col(cv) - F.col(val)
    return results.withColumn("gap", g).withColumn("status", gap_status(g))


# ------------------------------------------------------------------ importance / selection
def _importances(model: PipelineModel, feats: list[str]) -> list[tuple[str, float]]:
    tree = [s for s in model.stages if hasattr(s, "featureImportances")][-1]
    return list(zip(feats, map(float, tree.featureImportances.toArray())))


def feature_importance(model: PipelineModel, feats: list[str], top: int | None = None):
    """Native importances of the tree stage, sorted; returns a DataFrame (feature, importance)."""
    from pyspark.sql import SparkSession
    rows = sorted(_importances(model, feats), key=lambda r: (-r[1], r[0]))
    rows = rows[:top] if top else rows
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def importance_comparison(tables: dict[str, DataFrame], top: int = 20) -> DataFrame:
    """Outer union of (feature, importance) per method; missing -> 0; mean; top n."""
    long = reduce(lambda a, b: a.unionByName(b),
                  [t.select("feature", F.lit(m).alias("method"), "importance") for m, t in tables.items()])
    wide = long.groupBy("feature").pivot("method", list(tables)).agg(F.first("importance")).fillna(0.0)
    mean = sum((F.col(m) for m in tables), F.lit(0.0)) / len(tables)
    return wide.withColumn("mean_importance", mean).orderBy(F.desc("mean_importance"), "feature").limit(top)


def feistel(i: np.ndarray, n: int, seed: str, inverse: bool = False) -> np.ndarray:
    """A keyed bijection of 0..n-1: four Feistel rounds on the next even number of bits, walked until the result is below n."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.frombuffer(hashlib.sha256(seed.encode()).digest(), dtype=np.uint64)
    out = i.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        if inverse:
            left, right = right, left
        for k in keys[::-1] if inverse else keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f = (f * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 32)
            left, right = right, left ^ (f & mask)
        if inverse:
            left, right = right, left
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def permutation_importance(model, df: DataFrame, feats: list[str], repeats: int = 5, key: str = "row_id",
                           label: str = "y", seed: int = 42, threshold: float = 0.5, inputs: list[str] | None = None) -> DataFrame:
    """F1 drop when one column is permuted, per feature over the repeats.

    Rows are numbered by hash rank; in repeat r of feature f row i takes the value of row pi(i), a keyed bijection of the
    row numbers, so that the outcome does not depend on the partitioning. All features and repeats are
    one join and one pass of the model: each row sends its value (24 bytes) to the row that takes it. ``inputs``: all
    columns that the model reads (default: ``feats``)."""
    from ..operators import evaluate as ev
    from ..operators.splits import class_rank
    ship(df.sparkSession)
    inputs = list(inputs or feats)
    base_f1 = ev.basic_metrics(predict(model, df, "m", key, label, keep=()), [], label, "score", threshold, with_areas=False).first()["f1"]
    n = df.count()
    rows = df.select(qcol(key).alias(key), qcol(label).alias(label), F.array(*[qcol(c).cast("double") for c in inputs]).alias("_x")).withColumn("_one", F.lit(1))
    ranked = class_rank(rows, "_one", key, seed, counts={1: n}, out="_r").drop("_one")
    place = [inputs.index(f) for f in feats]
    runs = len(feats) * repeats

    def draw(batches):
        for b in batches:
            r, x = b.column("_r").to_numpy(), b.column("_x")
            for run in range(runs):
                f, repeat = divmod(run, repeats)
                to = pa.array(feistel(r, n, f"{seed}:{feats[f]}:{repeat}", inverse=True))
                yield pa.RecordBatch.from_arrays([to, pa.array(np.full(len(r), run, np.int32)), pc.list_element(x, place[f])], names=["_r", "_run", "_v"])

    drawn = ranked.select("_x", "_r").mapInArrow(draw, "_r long, _run int, _v double")
    spot = F.array(*[F.lit(p) for p in place])[(F.col("_run") / repeats).cast("int")]
    mixed = drawn.join(ranked, "_r").withColumn("_p", spot)
    mixed = mixed.select(key, label, "_run", *[F.when(F.col("_p") == i, F.col("_v")).otherwise(F.col("_x")[i]).alias(c) for i, c in enumerate(inputs)])
    scored = ev.basic_metrics(predict(model, mixed, "m", key, label, keep=("_run",)), ["_run"], label, "score", threshold, with_areas=False)
    name = F.array(*[F.lit(f) for f in feats])[(F.col("_run") / repeats).cast("int")]
    return (scored.select(name.alias("feature"), (F.lit(float(base_f1)) - F.col("f1")).alias("drop")).groupBy("feature")
            .agg(F.avg("drop").alias("mean_drop"), F.stddev_pop("drop").alias("std_drop")).orderBy(F.desc("mean_drop"), "feature"))


def rfecv(df: DataFrame, feats: list[str], kind: str = "gradboost", folds: int = 3, step: float = 0.1,
          min_features: int = 1, label: str = "y", key: str = "row_id", seed: int = 42, **params):
    """Recursive elimination by importance (drop ``step`` share of the remaining, at least one)
    with fold-averaged F1 at each size. Returns (best feature list, curve DataFrame)."""
    from ..operators import evaluate as ev
    data = stratified_folds(df, label, folds, key, seed).withColumnRenamed("fold", "_fold")

    def one(cur: list[str], f: int | None):
        """F1 on fold ``f`` of a fit on the other folds; for None the importances of a fit on all rows."""
        if f is None:
            return _importances(fit(data, cur, kind, label, scale=False, **params), cur)
        m = fit(data.where(F.col("_fold") != f), cur, kind, label, scale=False, **params)
        p = predict(m, data.where(F.col("_fold") == f), kind, key, label, keep=())
        return ev.basic_metrics(p, [], label, "score", 0.5, with_areas=False).first()["f1"]

    # fits of few rows wait for the driver most of their time: those of one size run side by side
    side = folds + 1 if data.count() <= SIDE_BY_SIDE_ROWS else 1
    cur = list(feats)
    curve = []
    with ThreadPool(side) as pool:
        while True:
            last = len(cur) <= min_features
            runs = [*range(folds), *([] if last else [None])]
            found = pool.map(inheritable_thread_target(df.sparkSession)(lambda f: one(cur, f)), runs, chunksize=1)
            scores = found[:folds]
            mean = sum(scores) / len(scores)
            curve.append((len(cur), mean, float((sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5), ",".join(cur)))
            if last:
                break
            n_drop = max(1, int(len(cur) * step))
            drop = {c for c, _ in sorted(found[folds], key=lambda r: (r[1], r[0]))[:n_drop]}
            cur = [c for c in cur if c not in drop]
            if len(cur) < min_features:
                break
    spark = df.sparkSession
    t = spark.createDataFrame(curve, "n_features int, f1_mean double, f1_std double, features string")
    best = max(curve, key=lambda r: (r[1], -r[0]))
    return best[3].split(","), t


def reduced_datasets(df: DataFrame, feats: list[str], keep=("row_id", "y", "split")) -> DataFrame:
    have = set(df.columns)
    return df.select(*[qcol(c) for c in list(keep) + feats if c in have])


# ------------------------------------------------------------------ ensembles needing fits
def bagging(train: DataFrame, score_on: DataFrame, feats: list[str], kind: str = "gradboost", n: int = 10,
            max_samples: float = 1.0, max_features: float = 1.0, label: str = "y", seed: int = 42, key: str = "row_id", **params) -> DataFrame:
    """n fits on bootstrap samples (and feature subsets), both drawn by hashes; mean probability per row.

    A row's number of copies in a sample is the Poisson quantile of its hash, whatever the partitioning."""
    size = max(1, int(round(max_features * len(feats))))
    below, term, steps = 0.0, math.exp(-max_samples), []
    for k in range(1, 12):
        below += term
        steps.append(below)
        term *= max_samples / k
    models = {}
    for i in range(n):
        fs = sorted(sorted(feats, key=lambda c: hashlib.md5(f"{seed}:{i}|{c}".encode()).hexdigest())[:size])
        # the hash is an array's element, so that it is taken once a row and not once a step
        drawn = F.transform(F.array(uniform(key, f"{seed}:{i}")), lambda u: reduce(lambda a, b: a + b, [(u >= x).cast("int") for x in steps]))[0]
        sample = train.withColumn("_c", F.explode(F.array_repeat(F.lit(0), F.coalesce(drawn, F.lit(0))))).drop("_c")
        models[f"bag{i}"] = fit(sample, fs, kind, label, scale=False, **params)
    # a row's mean where it is, then the mean of equal keys: every row has n scores
    keep = ["split"] if "split" in score_on.columns else []
    mean = reduce(lambda a, b: a + b, [F.col(m) for m in models]) / F.lit(float(n))
    scored = score_columns(models, score_on, key, label, keep).select(qcol(key), *keep, qcol(label), mean.alias("score"))
    return scored.groupBy(qcol(key), *keep, qcol(label)).agg(F.avg("score").alias("score")).withColumn("model", F.lit("bagging"))


def stack_refit(train: DataFrame, score_on: DataFrame, feats: list[str], kinds: list[str], folds: int = 5,
                label: str = "y", key: str = "row_id", seed: int = 42, passthrough: bool = False,
                params: dict | None = None, fitted: dict[str, PipelineModel] | None = None) -> DataFrame:
    """Out-of-fold base probabilities -> logistic meta-learner; bases refit on all training
    rows score ``score_on``. No in-fold prediction is ever used for the meta-learner. ``fitted``: these
    bases, if the caller has them."""
    data = stratified_folds(train, label, folds, key, seed).withColumnRenamed("fold", "_fold")
    bases = lambda rows: {kd: fit(rows, feats, kd, label, **(params or {}).get(kd, {})) for kd in kinds}
    firsts = [F.first(qcol(kd)).alias(kd) for kd in kinds]
    oof = []
    for f in range(folds):
        tr, ho = data.where(F.col("_fold") != f), data.where(F.col("_fold") == f)
        oof.append(score_columns(bases(tr), ho, key, label, keep=()))
    meta_in = reduce(lambda a, b: a.unionByName(b), oof).groupBy(qcol(key), qcol(label)).agg(*firsts)
    if passthrough:
        meta_in = meta_in.join(train.select(key, *feats), key)
    mcols = kinds + (feats if passthrough else [])
    meta = fit(meta_in, mcols, "logistic", label, scale=False)
    keep = [c for c in ("split",) if c in score_on.columns]
    piv = score_columns(fitted or bases(train), score_on, key, label, keep).groupBy(qcol(key), *keep, qcol(label)).agg(*firsts)
    if passthrough:
        piv = piv.join(score_on.select(key, *feats), key)
    return predict(meta, piv, "stacking", key, label, keep=tuple(keep))


def ensemble_importance(models: list, feats: list[str], top: int = 20) -> DataFrame:
    tabs = {f"m{i}": feature_importance(m, feats) for i, m in enumerate(models)}
    return importance_comparison(tabs, top)


def score_batch(model, df: DataFrame, feats: list[str], threshold: float = 0.5, key: str = "row_id",
                label_codes: bool = True, params: DataFrame | None = None) -> DataFrame:
    """(preparation by fitted ``params``) -> probability -> 0/1 at ``threshold`` -> label text; keeps the row key."""
    from ..functions.scalar import decode_label
    if params is not None:
        from .prepare import prepare_apply
        df = prepare_apply(df, params, key)
    out = model.transform(df)
    prob = F.col("_platt_prob") if "_platt_prob" in out.columns else F.col("probability")
    o = out.select(qcol(key), vector_to_array(prob)[1].alias("score"))
    o = o.withColumn("pred", (F.col("score") >= threshold).cast("int"))
    return o.withColumn("outcome", decode_label(F.col("pred"))) if label_codes else o


# ------------------------------------------------------------------ whole runs
def train_all_ensembles(train: DataFrame, score_on: DataFrame, feats: list[str], kinds: list[str], params: dict | None = None,
                        threshold: float = 0.5, folds: int = 3, bag: dict | None = None, label: str = "y", key: str = "row_id") -> DataFrame:
    """Soft vote, hard vote, bagging and stacking scored on the same rows; one row of metrics each."""
    from ..operators import evaluate as ev
    from . import ensembles as en
    models = {k: fit(train, feats, k, label, **(params or {}).get(k, {})) for k in kinds}
    long = reduce(lambda a, b: a.unionByName(b), [predict(m, score_on, k, key, label) for k, m in models.items()])
    v = cut_lineage(en.vote(long, row_key=key, y=label))
    scored = {"soft_vote": v.select(key, label, F.col("soft").alias("score")), "hard_vote": v.select(key, label, F.col("hard").cast("double").alias("score")),
              "bagging": bagging(train, score_on, feats, label=label, key=key, **(bag or {})),
              "stacking": stack_refit(train, score_on, feats, kinds, folds, label, key, params=params, fitted=models)}
    scored |= {n: cut_lineage(scored[n].select(key, label, "score")) for n in ("bagging", "stacking")}  # read twice below
    parts = [ev.evaluate_scores(p.select(key, label, "score"), [], threshold=threshold).withColumn("ensemble", F.lit(n)) for n, p in scored.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def auto_select_and_score(new: DataFrame, feats: list[str], models: dict[str, object] | None = None, results: DataFrame | None = None,
                          documents: str | None = None, params: DataFrame | None = None, key: str = "row_id") -> DataFrame:
    """Score ``new`` with the champion, at its own threshold, and publish labels: ``(key, score, pred, outcome, model)``.

    ``results``: a table (model, threshold, f1, ...) whose best row names one of ``models``. ``documents``: a folder of
    result documents; the one with the best F1 gives its stored test probabilities, by position of the rows
    in key order. With both, the better of the two."""
    from ..operators import results as rs
    from ..sources import sinks
    from .publish import with_position
    from ..functions.scalar import decode_label
    champ = None if results is None else rs.select_champion(results, tie=("model",)).first()
    doc = None
    if documents is not None:
        doc = sinks.read_result_documents(new.sparkSession, documents, name_filter="").orderBy(F.desc_nulls_last("f1"), "source").first()
    if champ is None and doc is None:
        raise ValueError("neither a result table nor result documents")
    if doc is not None and (champ is None or (doc["f1"] or 0.0) > champ["f1"]):
        stored = (sinks.read_predictions_json(new.sparkSession, documents, name_filter="").where(F.col("source") == doc["source"])
                  .select("position", F.col("proba").alias("score"), "pred"))
        rows = with_position(new.select(key), key).join(stored, "position").drop("position")
        return rows.withColumn("outcome", decode_label(F.col("pred"))).withColumn("model", F.lit(doc["method"]))
    name = next(k for k in models if k.lower() == champ["model"].lower())
    return score_batch(models[name], new, feats, champ["threshold"], key, params=params).withColumn("model", F.lit(name))
