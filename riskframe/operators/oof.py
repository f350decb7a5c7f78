"""Out-of-fold scores as a stored table, shared by thresholds, comparisons, stacking
and calibration (J16, K5, K8-K11).

Each (model, fold) pair is fitted once on the rows outside the fold and scores the rows
inside it; the long table ``(key, fold, label, model, score)`` is written once to the
shared folder. A threshold chosen from it was never seen by the model that gave the
score, so it can be reported on a test set that served for nothing else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.evaluate import curve_summary, model_curves, _cells, _metric_cols
from riskframe.operators.models import scored
from riskframe.session import side_by_side, written


def out_of_fold(estimators: dict, df: DataFrame, key: str, folds: list[int], fold: str = "fold", label: str = "label",
                synthetic: DataFrame | None = None) -> DataFrame:
    """(key, fold, label, model, score) of every row and model. ``synthetic``: rows with a
    column ``excluded`` that join the training rows of the fold they name, never the scored."""
    def one(job):
        f, name = job
        train, held = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
        if synthetic is not None:
            extra = synthetic.where(F.col("excluded") == f).drop("excluded")
            train = train.select(*extra.columns).unionByName(extra)
        return scored(estimators[name].fit(train), held, key, label).select(
            key, F.lit(f).alias("fold"), "label", F.lit(name).alias("model"), F.col("score").cast("double").alias("score"))

    parts = side_by_side(one, [(f, name) for f in folds for name in estimators], df)
    return written(reduce(DataFrame.unionByName, parts), "oof")


def wide_scores(oof: DataFrame, key: str, models: list[str]) -> DataFrame:
    """One row per key with a column ``s<i>`` per model: the input of a meta model."""
    columns = [F.max(F.when(F.col("model") == m, F.col("score"))).alias(f"s{i}") for i, m in enumerate(models)]
    return oof.groupBy(key, "fold", "label").agg(*columns)


def chosen_thresholds(oof: DataFrame, target: float = 0.70) -> DataFrame:
    """Per model, from its validation scores alone: AUC, best-F1 and target-recall threshold."""
    return curve_summary(model_curves(oof), target)


def report(estimators: dict, thresholds: DataFrame, train: DataFrame, test: DataFrame, key: str,
           which: str = "best_threshold", label: str = "label") -> DataFrame:
    """Metrics on the test rows of every model, refitted on all training rows, at the
    threshold chosen before; all models in one aggregation."""
    parts = side_by_side(lambda e: scored(e[1].fit(train), test, key, label).select(
        "label", F.lit(e[0]).alias("model"), F.col("score").cast("double").alias("score")), list(estimators.items()), train)
    rows = reduce(DataFrame.unionByName, parts).join(thresholds.select("model", F.col(which).alias("threshold")), "model")
    cells = (rows.withColumn("pred", (F.col("score") >= F.col("threshold")).cast("int")).groupBy("model", "threshold")
             .agg(*_cells("label", "pred")))
    accuracy, precision, recall, f1 = _metric_cols(*map(F.col, ("tp", "fp", "tn", "fn")))
    return cells.select("model", "threshold", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"), accuracy.alias("accuracy"),
                        precision.alias("precision_1"), recall.alias("recall_1"), f1.alias("f1_1"))
