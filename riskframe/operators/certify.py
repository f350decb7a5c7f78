"""Optimality certificates of fitted logistic models.

A convex training objective has a dual, and every feasible dual point bounds the
smallest possible objective from below. The gap between the objective of the fitted
coefficients and such a bound is therefore a proof, made from the data alone, of how
far the fit can be from the optimum at most. A wrong C, wrong weights, an early stop
or a constant model leave a gap.

With labels y = +-1, weights w of sum W, margins m = y f(x) and lambda = 1 / (C W):

* objective: ``sum(w * log(1 + exp(-m))) / W + lambda / 2 * |beta|^2``, the intercept free;
* dual point: numbers a in [0, 1] per row with ``sum(w a y) = 0``; its value is
  ``sum(w * entropy(a)) / W - |sum(w a y x) / W|^2 / (2 lambda)``.

As a serves the probability of the wrong class at the fit, scaled in one class so that
the two classes balance. That takes two aggregations by label, of which only the sums,
one vector of features per class, reach the driver.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _margins(model, df: DataFrame, features: str, label: str, weight_col: str | None) -> DataFrame:
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    return model.transform(df).select(
        F.col(features).alias("_x"), (F.col(label).cast("double") * 2 - 1).alias("_y"), weight.alias("_w"),
        vector_to_array(F.col("rawPrediction"))[1].alias("_f")).withColumn("_m", F.col("_y") * F.col("_f"))


def logistic_gap(model, df: DataFrame, C: float, weight_col: str | None = None, features: str = "features",
                 label: str = "label") -> dict:
    """Objective, lower bound and relative gap of a binary logistic model; also the
    size of the training set and the objective of the best constant model."""
    rows = _margins(model, df, features, label, weight_col)
    # log(1 + exp(-m)) and 1 / (1 + exp(m)), safe for any m
    loss = F.greatest(-F.col("_m"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_m")))
    wrong = F.when(F.col("_m") >= 0, F.exp(-F.col("_m")) / (1 + F.exp(-F.col("_m")))).otherwise(1 / (1 + F.exp("_m")))
    rows = rows.withColumn("_a", wrong)
    first = {r["_y"]: r for r in rows.groupBy("_y").agg(
        F.count("*").alias("n"), F.sum("_w").alias("w"), F.sum(F.col("_w") * loss).alias("loss"),
        F.sum(F.col("_w") * F.col("_a")).alias("a")).collect()}
    if len(first) < 2:
        raise ValueError("a certificate needs both classes")
    least = min(r["a"] for r in first.values())
    scale = F.when(F.col("_y") > 0, least / first[1.0]["a"]).otherwise(least / first[-1.0]["a"])
    rows = rows.withColumn("_a", F.col("_a") * scale)

    def part(p):  # p log p, 0 at 0
        return F.when(p > 0, p * F.log(p)).otherwise(0.0)

    second = {r["_y"]: r for r in rows.groupBy("_y").agg(
        F.sum(F.col("_w") * -(part(F.col("_a")) + part(1 - F.col("_a")))).alias("entropy"),
        Summarizer.sum(F.col("_x"), F.col("_w") * F.col("_a")).alias("v")).collect()}
    total = sum(r["w"] for r in first.values())
    beta = model.coefficients.toArray()
    reg = 1.0 / (C * total)
    objective = sum(r["loss"] for r in first.values()) / total + reg / 2 * float(beta @ beta)
    v = (second[1.0]["v"].toArray() - second[-1.0]["v"].toArray()) / total
    bound = sum(r["entropy"] for r in second.values()) / total - float(v @ v) / (2 * reg)
    p = first[1.0]["w"] / total
    return {"n_rows": int(sum(r["n"] for r in first.values())), "n_positive": int(first[1.0]["n"]), "objective": objective,
            "bound": bound, "gap": (objective - bound) / objective, "constant": -p * math.log(p) - (1 - p) * math.log(1 - p)}


def certificate(spark, name: str, summary: dict, tol: float) -> DataFrame:
    """One row: the size of the training set, whether the gap is proven to be at most
    ``tol`` of the objective, and whether the fit beats the best constant model."""
    return spark.createDataFrame(
        [(name, summary["n_rows"], summary["n_positive"], bool(summary["gap"] <= tol),
          bool(summary["objective"] <= summary["constant"] * (1 + 1e-9)))],
        "model string, n_rows long, n_positive long, optimal boolean, beats_constant boolean")
