from pyspark.sql import functions as F
import numpy as np
import pytest

from riskframe.operators import evaluate as EV


def _scored(spark, scores, labels):
    return spark.createDataFrame([(i, int(y), float(s)) for i, (s, y) in enumerate(zip(scores, labels))],
                                 "id int, label int, score double")


def _auc_brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rng = np.random.default_rng(5)
    s = np.round(rng.random(300), 1)
    y = (rng.random(300) < 0.4).astype(int)
    got = EV.auc(_scored(spark, s, y)).first()[0]
    assert got == pytest.approx(_auc_brute(s, y))
    roc = EV.roc_curve(_scored(spark, s, y)).orderBy("threshold", ascending=False).collect()
    assert len(roc) == len(set(s)) and roc[-1]["tpr"] == 1.0 and roc[-1]["fpr"] == 1.0


def test_separable_and_one_class(spark):
    assert EV.auc(_scored(spark, [0.1, 0.2, 0.8, 0.9], [0, 0, 1, 1])).first()[0] == 1.0
    one = _scored(spark, [0.1, 0.7], [0, 0])
    assert EV.auc(one).first()[0] is None
    m = EV.binary_metrics(EV.at_threshold(one, 0.5)).first()
    assert (m["precision_1"], m["recall_1"], m["f1_1"]) == (0.0, 0.0, 0.0)


def test_target_recall_picks_largest_threshold(spark):
    s = _scored(spark, [0.9, 0.8, 0.7, 0.6], [1, 0, 1, 1])
    assert EV.threshold_for_target_recall(s, 0.6).first()[0] == 0.7
    assert EV.threshold_for_target_recall(s, 1.01).first()[0] == 0.5


def test_confusion_and_report(spark):
    s = EV.at_threshold(_scored(spark, [0.9, 0.8, 0.2, 0.1], [1, 0, 1, 0]), 0.5)
    cells = {(r["label"], r["pred"]): r["count"] for r in EV.confusion_matrix(s).collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 1}
    rep = {r["class"]: r for r in EV.classification_report(s).collect()}
    assert rep["1"]["precision"] == 0.5 and rep["accuracy"]["f1"] == 0.5 and rep["macro avg"]["support"] == 4


def test_sweep(spark):
    s = _scored(spark, [0.9, 0.8, 0.7, 0.6], [1, 0, 1, 1])
    rows = {r["threshold"]: r for r in EV.sweep_thresholds(s, [0.75, 0.65]).collect()}
    assert rows[0.75]["recall_1"] == pytest.approx(1 / 3) and rows[0.65]["precision_1"] == pytest.approx(2 / 3)


def test_curves_of_many_models_equal_single_ones(spark):
    import random
    rng = random.Random(1)
    rows = [(m, int(rng.random() < 0.3), round(rng.random(), 1 + m % 2)) for m in range(4) for _ in range(60)]
    rows += [(None, 1, 0.5), (None, 0, 0.25), (9, 0, 0.5), (9, 0, 0.7)]  # a null model, and one with one class
    long = spark.createDataFrame(rows, "model int, label int, score double").repartition(3)
    curves = EV.model_curves(long).collect()
    summary = {r["model"]: r for r in EV.curve_summary(EV.model_curves(long)).collect()}
    for m in (0, 1):
        one = long.where(f"model = {m}")
        want = {(r["threshold"], r["fpr"], r["tpr"]) for r in EV.roc_curve(one).collect()}
        assert {(r["threshold"], r["fpr"], r["tpr"]) for r in curves if r["model"] == m} == want
        assert abs(summary[m]["auc"] - EV.auc(one).first()[0]) < 1e-12
        best = EV.best_f1_threshold(one).first()
        assert (summary[m]["best_threshold"], summary[m]["best_f1"]) == (best["threshold"], best["f1"])
        assert summary[m]["target_threshold"] == EV.threshold_for_target_recall(one, 0.7).first()[0]
    assert summary[9]["auc"] is None and summary[None]["auc"] == 1.0


def test_running_sums_of_groups_with_nulls(spark):
    from riskframe.functions.prefix import prefix_sums
    rows = [(None if i % 5 == 0 else "g", i, None if i % 7 == 0 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, i int, x double").repartition(4)
    got = sorted((r["i"], r["cum_x"]) for r in prefix_sums(df, [F.col("i")], ["x"], ["g"], inclusive=False, partitions=6).collect())
    run = {}
    for g, i, x in rows:
        assert got[i] == (i, run.get(g, 0.0))
        run[g] = run.get(g, 0.0) + (x or 0.0)
