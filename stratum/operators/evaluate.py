"""Evaluation of binary scores over a long prediction table.

Input: one row per prediction with group keys (e.g. model, imputation, version), a 0/1
label and a score. Every operator is a ``groupBy`` over that table. Curves and areas are
computed from counts per *distinct score* plus running totals (``running.py``), so no
operator sorts raw rows or holds a group in one task.

Conventions (fixed, to match the source project's metric library):
precision/recall/F1/specificity/NPV are 0 when undefined; AUC is NULL for one class;
the PR-optimal threshold maximises ``2pr/(p+r+1e-9)`` over distinct scores, ties to the
smallest threshold; grid search keeps the first strict maximum above 0, else 0.5.
"""
from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalar import qcol, safe_div
from ..session import cut_lineage
from .running import running_totals

F1_EPS = 1e-9


def grid(start: float, stop: float, step: float) -> list[float]:
    """Same doubles as ``numpy.arange(start, stop, step)``."""
    return [float(v) for v in np.arange(start, stop, step)]


DEFAULT_GRID = grid(0.1, 1.0, 0.01)          # 0.10 .. 0.99
SENSITIVITY_GRID = grid(0.1, 0.95, 0.05)     # 0.10 .. 0.90


def _k(keys):
    return list(keys or [])


# ------------------------------------------------------------------ counts
def score_counts(preds: DataFrame, keys=(), y: str = "y", score: str = "score") -> DataFrame:
    """keys, score, pos, neg – one row per distinct score (map-side partial aggregation)."""
    keys = _k(keys)
    return (preds.groupBy(*keys, qcol(score).alias("score"))
                 .agg(F.count_if(qcol(y) == 1).alias("pos"), F.count_if(qcol(y) != 1).alias("neg")))


def _totals(sc: DataFrame, keys) -> DataFrame:
    return sc.groupBy(*keys).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def cumulative_counts(preds: DataFrame, keys=(), y: str = "y", score: str = "score") -> DataFrame:
    """keys, score, pos, neg, tp, fp (counts with score >= this score), n_pos, n_neg."""
    keys = _k(keys)
    if not keys:
        return cumulative_counts(preds.withColumn("_all", F.lit(0)), ["_all"], y, score).drop("_all")
    sc = score_counts(preds, keys, y, score)
    cum = running_totals(sc, keys, "score", ["pos", "neg"], descending=True, totals=True)
    return cum.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp", "tot_pos": "n_pos", "tot_neg": "n_neg"})


# ------------------------------------------------------------------ curves and areas
def roc_curve(preds: DataFrame, keys=(), y="y", score="score") -> DataFrame:
    c = cumulative_counts(preds, keys, y, score)
    return c.select(*_k(keys), F.col("score").alias("threshold"),
                    safe_div(F.col("fp"), F.col("n_neg")).alias("fpr"),
                    safe_div(F.col("tp"), F.col("n_pos")).alias("tpr"))


def _area_terms(c: DataFrame) -> DataFrame:
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    prec = tp / (tp + fp)
    tp0, fp0 = tp - pos, fp - neg
    prev_prec = F.when(tp0 + fp0 > 0, tp0 / (tp0 + fp0)).otherwise(F.lit(1.0))
    return c.select(
        "*",
        # ROC: positives at this score beat negatives below it, half of the tied ones
        (pos * (F.col("n_neg") - fp + neg / 2.0)).alias("_auc"),
        # AP: sum of recall steps times precision
        (pos * prec).alias("_ap"),
        # PR trapezoid between previous and current point
        (pos * (prec + prev_prec) / 2.0).alias("_trap"))


def areas(preds: DataFrame, keys=(), y="y", score="score") -> DataFrame:
    """keys, n_pos, n_neg, auc_roc, average_precision, pr_auc."""
    return _areas_of(cumulative_counts(preds, keys, y, score), keys)


def _areas_of(cumulative: DataFrame, keys=()) -> DataFrame:
    keys = _k(keys)
    t = _area_terms(cumulative)
    P, N = F.first("n_pos"), F.first("n_neg")
    agg = t.groupBy(*keys).agg(P.alias("n_pos"), N.alias("n_neg"), F.sum("_auc").alias("s_auc"),
                               F.sum("_ap").alias("s_ap"), F.sum("_trap").alias("s_trap"))
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    return agg.select(*keys, "n_pos", "n_neg",
                      F.when(both, F.col("s_auc") / (F.col("n_pos") * F.col("n_neg"))).alias("auc_roc"),
                      F.when(F.col("n_pos") > 0, F.col("s_ap") / F.col("n_pos")).alias("average_precision"),
                      F.when(F.col("n_pos") > 0, F.col("s_trap") / F.col("n_pos")).alias("pr_auc"))


def roc_auc(preds, keys=(), y="y", score="score") -> DataFrame:
    return areas(preds, keys, y, score).select(*_k(keys), "auc_roc")


def average_precision(preds, keys=(), y="y", score="score") -> DataFrame:
    return areas(preds, keys, y, score).select(*_k(keys), "average_precision", "pr_auc")


def pr_curve(preds, keys=(), y="y", score="score") -> DataFrame:
    c = cumulative_counts(preds, keys, y, score)
    rec = F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).otherwise(F.lit(1.0))
    return c.select(*_k(keys), F.col("score").alias("threshold"),
                    (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), rec.alias("recall"))


def best_threshold_pr(preds, keys=(), y="y", score="score", digits: int = 4) -> DataFrame:
    """Threshold with maximal 2pr/(p+r+1e-9) among distinct scores (ties: smallest);
    F1/precision/recall recomputed at ``score >= threshold``; all rounded to ``digits``."""
    keys = _k(keys)
    c = pr_curve(preds, keys, y, score)
    p, r = F.col("precision"), F.col("recall")
    f1e = 2 * p * r / (p + r + F1_EPS)
    best = (c.withColumn("_f", f1e)
              .groupBy(*keys)
              .agg(F.max(F.struct(F.col("_f"), (-F.col("threshold")).alias("_nt"),
                                  F.col("precision").alias("_p"), F.col("recall").alias("_r"))).alias("b")))
    P, R = F.col("b._p"), F.col("b._r")
    f1 = F.when(P + R > 0, 2 * P * R / (P + R)).otherwise(F.lit(0.0))
    return best.select(*keys, F.round(-F.col("b._nt"), digits).alias("threshold"),
                       F.round(f1, digits).alias("f1"), F.round(P, digits).alias("precision"),
                       F.round(R, digits).alias("recall"))


# ------------------------------------------------------------------ fixed thresholds
def confusion_counts(preds: DataFrame, keys=(), y="y", pred="pred") -> DataFrame:
    keys = _k(keys)
    yy, pp = qcol(y), qcol(pred)
    return preds.groupBy(*keys).agg(
        F.count_if((yy != 1) & (pp != 1)).alias("tn"), F.count_if((yy != 1) & (pp == 1)).alias("fp"),
        F.count_if((yy == 1) & (pp != 1)).alias("fn"), F.count_if((yy == 1) & (pp == 1)).alias("tp"))


def normalised_confusion(counts: DataFrame, keys=()) -> DataFrame:
    """Row-normalised confusion matrix of a ``confusion_counts`` result: one row per actual class with the shares of its
    rows predicted 0 and 1 (0 for a class without rows)."""
    rows = F.array(*[F.struct(F.lit(c).alias("actual"), (F.col(a) + F.col(b)).alias("n_rows"), safe_div(F.col(a), F.col(a) + F.col(b)).alias("predicted_0"),
                              safe_div(F.col(b), F.col(a) + F.col(b)).alias("predicted_1")) for c, a, b in ((0, "tn", "fp"), (1, "fn", "tp"))])
    return counts.select(*_k(keys), F.inline(rows))


def metrics_from_counts(cc: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cc.select(
        "*",
        safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        safe_div(tp, tp + fp).alias("precision"),
        safe_div(tp, tp + fn).alias("recall"),
        safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        safe_div(tn, tn + fp).alias("specificity"),
        safe_div(tn, tn + fn).alias("npv"))


def with_prediction(preds: DataFrame, threshold, score="score", out="pred") -> DataFrame:
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return preds.withColumn(out, (qcol(score) >= t).cast("int"))


def basic_metrics(preds: DataFrame, keys=(), y="y", score="score", threshold=0.5,
                  with_areas: bool = True) -> DataFrame:
    """Counts, accuracy, precision, recall, F1, specificity, NPV (+ AUC-ROC and AP)."""
    keys = _k(keys)
    m = metrics_from_counts(confusion_counts(with_prediction(preds, threshold, score), keys, y, "pred"))
    if not with_areas:
        return m
    if not keys:
        m = m.withColumn("_all", F.lit(0))
        a = areas(preds.withColumn("_all", F.lit(0)), ["_all"], y, score)
        return m.join(a.select("_all", "auc_roc", F.col("average_precision").alias("auc_pr")), "_all").drop("_all")
    a = areas(preds, keys, y, score).select(*keys, "auc_roc", F.col("average_precision").alias("auc_pr"))
    return m.join(a, keys)


def evaluate_scores(preds, keys=(), y="y", score="score", threshold=0.5, digits=4) -> DataFrame:
    """Metrics of a probability column at a given cut, rounded."""
    m = basic_metrics(preds, keys, y, score, threshold)
    cols = ["accuracy", "precision", "recall", "f1", "specificity", "npv", "auc_roc", "auc_pr"]
    return m.select(*_k(keys), "tn", "fp", "fn", "tp", *[F.round(c, digits).alias(c) for c in cols])


def class_report(preds: DataFrame, keys=(), y="y", pred="pred") -> DataFrame:
    """Per class precision/recall/F1/support plus macro and weighted averages."""
    keys = _k(keys)
    cc = confusion_counts(preds, keys, y, pred)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    c1 = cc.select(*keys, F.lit("1").alias("label"), safe_div(tp, tp + fp).alias("precision"),
                   safe_div(tp, tp + fn).alias("recall"), safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                   (tp + fn).alias("support"))
    c0 = cc.select(*keys, F.lit("0").alias("label"), safe_div(tn, tn + fn).alias("precision"),
                   safe_div(tn, tn + fp).alias("recall"), safe_div(2 * tn, 2 * tn + fn + fp).alias("f1"),
                   (tn + fp).alias("support"))
    per = c0.unionByName(c1)
    g = per.groupBy(*keys)
    tot = F.sum("support")
    macro = g.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                  F.avg("f1").alias("f1"), tot.alias("support")).withColumn("label", F.lit("macro avg"))
    wavg = lambda c: safe_div(F.sum(F.col(c) * F.col("support")), tot)
    weighted = g.agg(wavg("precision").alias("precision"), wavg("recall").alias("recall"),
                     wavg("f1").alias("f1"), tot.alias("support")).withColumn("label", F.lit("weighted avg"))
    return per.unionByName(macro).unionByName(weighted)


# ------------------------------------------------------------------ threshold grids
def _reached(score: Column, cuts: list[float], below: int = 0) -> Column:
    """How many of the ascending cuts a score reaches (null: none), as a binary search in one compiled expression."""
    if not cuts:
        return F.lit(below)
    mid = len(cuts) // 2
    return F.when(score >= cuts[mid], _reached(score, cuts[mid + 1:], below + mid + 1)).otherwise(_reached(score, cuts[:mid], below))


def _grid_counts(preds, keys, y, score, thresholds):
    """tp/fp for ``score >= g`` at every grid value g, by binning: one scan and one aggregate.

    A row's bin is the number of grid values that its score reaches; there are len(thresholds) + 1 bins, so that each
    group becomes an array of that length, whose sums from a bin on are the counts at a grid value."""
    keys = _k(keys)
    if not keys:
        out = _grid_counts(preds.withColumn("_all", F.lit(0)), ["_all"], y, score, thresholds)
        return out.drop("_all")
    values = [float(t) for t in thresholds]
    bins = (preds.groupBy(*keys, _reached(qcol(score), sorted(values)).alias("bin"))
                 .agg(F.count_if(qcol(y) == 1).alias("pos"), F.count_if(qcol(y) != 1).alias("neg")))
    one = bins.groupBy(*keys).agg(F.collect_list(F.struct("bin", "pos", "neg")).alias("_bins"))

    def total(what: str, least) -> Column:
        return F.aggregate("_bins", F.lit(0).cast("long"), lambda n, x: n + F.when(x["bin"] >= least, x[what]).otherwise(F.lit(0)))

    points = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(i).alias("grid_idx"), F.lit(sum(u <= t for u in values)).alias("least"))
                       for i, t in enumerate(values)])
    at = one.select("*", F.inline(points))
    at = at.select(*keys, "grid_idx", "threshold", total("pos", F.col("least")).alias("tp"), total("neg", F.col("least")).alias("fp"),
                   total("pos", F.lit(0)).alias("_p"), total("neg", F.lit(0)).alias("_n"))
    return at.select(*keys, "grid_idx", "threshold", "tp", "fp", (F.col("_p") - F.col("tp")).alias("fn"), (F.col("_n") - F.col("fp")).alias("tn"))


def threshold_sensitivity(preds, keys=(), y="y", score="score", thresholds=None) -> DataFrame:
    """All fixed-cut metrics at each grid threshold (default 0.10..0.90 step 0.05)."""
    thresholds = thresholds or SENSITIVITY_GRID
    return metrics_from_counts(_grid_counts(preds, keys, y, score, thresholds))


def best_threshold_grid(preds, keys=(), y="y", score="score", metric: str = "f1",
                        thresholds=None) -> DataFrame:
    """First strict maximum of ``metric`` over the grid; 0.5 and score 0 when none is > 0."""
    keys = _k(keys)
    thresholds = thresholds or DEFAULT_GRID
    m = metrics_from_counts(_grid_counts(preds, keys, y, score, thresholds))
    if metric == "youden":
        m = m.withColumn("youden", F.col("recall") + F.col("specificity") - 1)
    best = m.groupBy(*keys).agg(F.max(F.struct(F.col(metric).alias("s"), (-F.col("grid_idx")).alias("ni"),
                                               F.col("threshold").alias("t"))).alias("b"))
    ok = F.col("b.s") > 0
    return best.select(*keys, F.when(ok, F.col("b.t")).otherwise(F.lit(0.5)).alias("threshold"),
                       F.when(ok, F.col("b.s")).otherwise(F.lit(0.0)).alias("best_score"),
                       F.lit(metric).alias("metric"))


# ------------------------------------------------------------------ tables
def calibration_table(preds, keys=(), y="y", score="score", bins: int = 10) -> DataFrame:
    """Mean score and fraction of positives per equal-width bin on [0, 1]; empty bins absent."""
    keys = _k(keys)
    b = F.least(F.floor(qcol(score) * bins), F.lit(bins - 1)).cast("int")
    return (preds.groupBy(*keys, b.alias("bin"))
                 .agg(F.avg(qcol(score)).alias("mean_score"), F.avg(qcol(y).cast("double")).alias("frac_pos"),
                      F.count(F.lit(1)).alias("n_rows")))


def score_histogram_by_class(preds, keys=(), y="y", score="score", bins: int = 30) -> DataFrame:
    """Density histogram (30 bins on [0, 1]) per class."""
    keys = _k(keys)
    b = F.least(F.floor(qcol(score) * bins), F.lit(bins - 1)).cast("int")
    h = preds.groupBy(*keys, qcol(y).alias("y"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy(*keys, "y")
    return h.withColumn("density", F.col("n_rows") / (F.sum("n_rows").over(w) * (1.0 / bins)))


def apply_thresholds(preds: DataFrame, thresholds: DataFrame, keys, score="score") -> DataFrame:
    """Attach each group's stored threshold (groups without one are skipped) and predict."""
    keys = _k(keys)
    t = thresholds.select(*keys, F.col("threshold").alias("_thr"))
    return (preds.join(t, keys, "inner")
                 .withColumn("pred", (qcol(score) >= F.col("_thr")).cast("int")))


def evaluate_on_test(preds: DataFrame, thresholds: DataFrame, keys, y="y", score="score",
                     split_col="split", split="test", digits: int = 4) -> DataFrame:
    """Each group at its stored threshold on the test split: threshold, f1, precision, recall, auc."""
    keys = _k(keys)
    # one table of counts per distinct score serves the threshold and the area
    cum = cut_lineage(cumulative_counts(preds.where(qcol(split_col) == split), keys, y, score))
    at = cum.join(thresholds.select(*keys, F.col("threshold").alias("_thr")), keys)
    over, under = F.col("score") >= F.col("_thr"), F.col("score") < F.col("_thr")
    counts = [F.sum(F.when(c, F.col(n)).otherwise(F.lit(0))).alias(o) for c, n, o in ((under, "neg", "tn"), (over, "neg", "fp"), (under, "pos", "fn"), (over, "pos", "tp"))]
    cc = metrics_from_counts(at.groupBy(*keys, "_thr").agg(*counts))
    a = _areas_of(cum, keys).select(*keys, "auc_roc")
    return cc.join(a, keys).select(*keys, F.col("_thr").alias("threshold"),
                                   F.round("f1", digits).alias("f1"),
                                   F.round("precision", digits).alias("precision"),
                                   F.round("recall", digits).alias("recall"),
                                   F.round("auc_roc", digits).alias("auc"))


def prediction_distribution(df: DataFrame, label: str = "pred", keys=()) -> DataFrame:
    keys = _k(keys)
    w = Window.partitionBy(*keys)
    return (df.groupBy(*keys, qcol(label).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("pct", F.round(F.col("n_rows") * 100.0 / F.sum("n_rows").over(w), 6)))


def agreement_rate(a: DataFrame, b: DataFrame, key: str = "row_id", label: str = "pred") -> DataFrame:
    """Share of rows (joined on ``key``) where both prediction sets agree."""
    j = a.select(key, qcol(label).alias("_a")).join(b.select(key, qcol(label).alias("_b")), key)
    return j.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.avg((F.col("_a") == F.col("_b")).cast("double")).alias("agreement"))
