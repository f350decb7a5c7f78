"""Evaluation on a scored frame ``(label, score[, pred])``.

Counts are one conditional aggregation; curves pre-aggregate per distinct
score and take exact cumulative counts with ``prefix_sums`` (range-partitioned,
never one task); AUC is the trapezoid rule over those points, which equals the
Mann-Whitney statistic with ties counted half.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.prefix import prefix_sums


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def at_threshold(scored: DataFrame, thr: float, score: str = "score",
                 pred: str = "pred") -> DataFrame:
    return scored.withColumn(pred, (F.col(score) >= F.lit(float(thr))).cast("int"))


def _cells(label: str, pred: str):
    y, p = F.col(label), F.col(pred)
    return [F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn")]


def confusion_matrix(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """All four cells, zero cells included."""
    return scored.agg(*_cells(label, pred)).selectExpr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (label, pred, count)")


def _metric_cols(tp, fp, tn, fn):
    def div(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    precision = div(tp, tp + fp)
    recall = div(tp, tp + fn)
    f1 = div(2 * tp, 2 * tp + fp + fn)
    accuracy = div(tp + tn, tp + fp + tn + fn)
    return accuracy, precision, recall, f1


def binary_metrics(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """accuracy, precision/recall/F1 of class 1 (zero_division = 0)."""
    cells = scored.agg(*_cells(label, pred))
    acc, pre, rec, f1 = _metric_cols(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    return cells.select(acc.alias("accuracy"), pre.alias("precision_1"), rec.alias("recall_1"),
                        f1.alias("f1_1"), "tp", "fp", "tn", "fn")


def classification_report(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Per-class precision/recall/F1/support, then accuracy, macro and
    support-weighted averages, as rows."""
    cells = scored.agg(*_cells(label, pred))
    tp, fp, tn, fn = F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn")
    _, p1, r1, f1 = _metric_cols(tp, fp, tn, fn)
    _, p0, r0, f0 = _metric_cols(tn, fn, tp, fp)  # class 0 seen as positive
    acc, _, _, _ = _metric_cols(tp, fp, tn, fn)
    s0, s1 = (tn + fp), (tp + fn)
    n = s0 + s1
    wavg = lambda a, b: F.coalesce(F.try_divide(a * s0 + b * s1, n.cast("double")), F.lit(0.0))
    wide = cells.select(
        p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"), acc.alias("acc"),
        n.alias("n"), ((p0 + p1) / 2).alias("mp"), ((r0 + r1) / 2).alias("mr"),
        ((f0 + f1) / 2).alias("mf"), wavg(p0, p1).alias("wp"), wavg(r0, r1).alias("wr"),
        wavg(f0, f1).alias("wf"))
    return wide.selectExpr(
        "stack(5, '0', p0, r0, f0, s0, '1', p1, r1, f1, s1, "
        "'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n, "
        "'macro avg', mp, mr, mf, n, 'weighted avg', wp, wr, wf, n) "
        "AS (class, precision, recall, f1, support)")


def _score_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: positives and negatives, then exact cumulative
    counts in descending score order."""
    per = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).cast("long").alias("pos"),
        F.count_if(F.col(label) == 0).cast("long").alias("neg"))
    return prefix_sums(per, [F.col("threshold").desc()], ["pos", "neg"])


def _totals(scored: DataFrame, label: str):
    row = scored.agg(F.count_if(F.col(label) == 1).alias("P"),
                     F.count_if(F.col(label) == 0).alias("N")).first()
    return row["P"], row["N"]


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, descending."""
    P, N = _totals(scored, label)
    cum = _score_counts(scored, label, score)
    div = lambda a, b: F.try_divide(a.cast("double"), F.lit(float(b))) if b else F.lit(None).cast("double")
    return cum.select("threshold", div(F.col("cum_neg"), N).alias("fpr"),
                      div(F.col("cum_pos"), P).alias("tpr"))


def auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC (trapezoids from (0,0)); null for a single class."""
    P, N = _totals(scored, label)
    if not P or not N:
        return scored.sparkSession.createDataFrame([(None,)], "auc double")
    cum = _score_counts(scored, label, score)
    before = F.col("cum_pos") - F.col("pos")
    area = F.col("neg") * (before + F.col("pos") / 2.0)
    return cum.agg((F.sum(area) / F.lit(float(P) * float(N))).alias("auc"))


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) at every distinct score, descending."""
    P, _ = _totals(scored, label)
    cum = _score_counts(scored, label, score)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")).cast("double")
    recall = (F.try_divide(F.col("cum_pos").cast("double"), F.lit(float(P))) if P
              else F.lit(0.0))
    return cum.select("threshold", precision.alias("precision"), recall.alias("recall"))


def model_curves(scored: DataFrame, model: str = "model", label: str = "label", score: str = "score") -> DataFrame:
    """ROC and precision-recall points of all models of a long frame ``(model, label,
    score)`` at once: (model, threshold, pos, neg, cum_pos, cum_neg, fpr, tpr, precision,
    recall), one row per model and distinct score. The running counts of all models come
    from one range partitioning, so neither a model nor a score is a hot key; rates of a
    class that a model lacks are null."""
    per = scored.groupBy(model, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).cast("long").alias("pos"), F.count_if(F.col(label) == 0).cast("long").alias("neg"))
    cum = prefix_sums(per, [F.col("threshold").desc()], ["pos", "neg"], [model])
    totals = scored.groupBy(F.col(model).alias("_m")).agg(  # one row per model
        F.count_if(F.col(label) == 1).alias("_P"), F.count_if(F.col(label) == 0).alias("_N"))
    rate = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    tpr = rate(F.col("cum_pos"), F.col("_P"))
    return cum.join(totals, F.col(model).eqNullSafe(F.col("_m"))).select(
        model, "threshold", "pos", "neg", "cum_pos", "cum_neg", rate(F.col("cum_neg"), F.col("_N")).alias("fpr"), tpr.alias("tpr"),
        rate(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"), tpr.alias("recall"))


def curve_summary(curves: DataFrame, target: float = 0.70, fallback: float = 0.50, model: str = "model") -> DataFrame:
    """Per model, in one aggregation over its curve: the area under ROC, average precision,
    the threshold of the best F1 (the largest on ties) and the largest threshold that
    reaches the target recall, else the fallback."""
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0))
    best = F.max(F.struct(f1.alias("f1"), "threshold"))
    return curves.groupBy(model).agg(
        F.try_divide(area, F.max("cum_pos").cast("double") * F.max("cum_neg")).alias("auc"),
        F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.max("cum_pos").cast("double")).alias("average_precision"),
        best["threshold"].alias("best_threshold"), best["f1"].alias("best_f1"),
        F.coalesce(F.max(F.when(F.col("recall") >= F.lit(target), F.col("threshold"))), F.lit(float(fallback))).alias("target_threshold"))


def eval_at_threshold(scored: DataFrame, thr: float, label: str = "label",
                      score: str = "score") -> DataFrame:
    m = binary_metrics(at_threshold(scored, thr, score, "_pred"), label, "_pred")
    return m.select(F.lit(float(thr)).alias("threshold"), "accuracy", "precision_1", "recall_1")


def threshold_for_target_recall(scored: DataFrame, target: float = 0.70, fallback: float = 0.50,
                                label: str = "label", score: str = "score") -> DataFrame:
    """Largest threshold whose recall reaches the target (the highest
    precision point that does), else the fallback."""
    pr = pr_curve(scored, label, score)
    return pr.agg(F.coalesce(F.max(F.when(F.col("recall") >= F.lit(target), F.col("threshold"))),
                             F.lit(float(fallback))).alias("threshold"))


def sweep_thresholds(scored: DataFrame, thresholds: list[float], label: str = "label",
                     score: str = "score") -> DataFrame:
    """Metrics at each threshold, all thresholds in one pass."""
    y, s = F.col(label), F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        p = s >= F.lit(float(t))
        aggs += [F.count_if((y == 1) & p).alias(f"tp{i}"), F.count_if((y == 0) & p).alias(f"fp{i}"),
                 F.count_if((y == 0) & ~p).alias(f"tn{i}"), F.count_if((y == 1) & ~p).alias(f"fn{i}")]
    wide = scored.agg(*aggs)
    stack = ", ".join(f"CAST({float(t)!r} AS DOUBLE), tp{i}, fp{i}, tn{i}, fn{i}"
                      for i, t in enumerate(thresholds))
    long = wide.selectExpr(f"stack({len(thresholds)}, {stack}) AS (threshold, tp, fp, tn, fn)")
    acc, pre, rec, _ = _metric_cols(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    return long.select("threshold", acc.alias("accuracy"), pre.alias("precision_1"),
                       rec.alias("recall_1"))


def best_f1_threshold(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Threshold maximising F1 of class 1 (largest threshold on ties)."""
    pr = pr_curve(scored, label, score)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return pr.withColumn("f1", f1).agg(
        F.max_by(F.struct("threshold", "f1"), F.struct("f1", "threshold")).alias("b")).select(
        F.col("b.threshold").alias("threshold"), F.col("b.f1").alias("f1"))


def model_comparison(rows: list[DataFrame]) -> DataFrame:
    """Union of per-model metric rows, F1 recomputed as 2PR/(P+R)."""
    from functools import reduce
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision_1") * F.col("recall_1"),
                                 F.col("precision_1") + F.col("recall_1")), F.lit(0.0))
    return out.withColumn("f1_1", f1)


def timed_fit(estimator, df: DataFrame):
    """(model, seconds): wall time around ``fit``, which runs the jobs."""
    t0 = time.perf_counter()
    model = estimator.fit(df)
    return model, time.perf_counter() - t0
