"""Voting, stacking and calibration.

Base models score the same frame in one chain of projections (each model's
output columns renamed), so combining needs no join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.isotonic import Isotonic
from riskframe.operators.machines import MappedSvm, fit_folds
from riskframe.session import side_by_side


def _base_score(model, df: DataFrame, i: int) -> DataFrame:
    """Apply one fitted model, keeping its score/pred as ``s{i}``/``p{i}``: the
    probability of class 1, else the margin, else its own ``score``."""
    out = model.transform(df)
    if "probability" in out.columns:
        score = vector_to_array(F.col("probability"))[1]
    elif "rawPrediction" in out.columns:
        score = vector_to_array(F.col("rawPrediction"))[1]
    else:
        score = F.col("score")
    pred = F.col("prediction" if "prediction" in out.columns else "pred").cast("int")
    out = out.withColumn(f"s{i}", score).withColumn(f"p{i}", pred)
    return out.drop(*[c for c in ("probability", "rawPrediction", "prediction", "score", "pred") if c in out.columns])


def combine_votes(df: DataFrame, n: int, mode: str = "hard") -> DataFrame:
    """hard: majority of base predictions; soft: mean base score >= 0.5."""
    if mode == "soft":
        mean = reduce(lambda a, b: a + b, [F.col(f"s{i}") for i in range(n)]) / n
        return df.withColumn("score", mean).withColumn("pred", (mean >= 0.5).cast("int"))
    votes = reduce(lambda a, b: a + b, [F.col(f"p{i}") for i in range(n)])
    return (df.withColumn("score", votes / F.lit(float(n)))
            .withColumn("pred", (votes * 2 > n).cast("int")))


class Voting:
    def __init__(self, estimators: list, mode: str = "hard"):
        self.estimators, self.mode = estimators, mode

    def fit(self, df: DataFrame) -> "VotingModel":
        models = side_by_side(lambda e: e.fit(df), self.estimators, df)
        if self.mode == "soft":
            out = [m.transform(df).columns for m in models]
            if any("probability" not in c and "score" not in c for c in out):
                raise ValueError("soft voting averages probabilities: calibrate members that give margins first")
        return VotingModel(models, self.mode)


class VotingModel:
    def __init__(self, models, mode):
        self.models, self.mode = models, mode

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for i, m in enumerate(self.models):
            out = _base_score(m, out, i)
        return combine_votes(out, len(self.models), self.mode)


class Stacking:
    """Out-of-fold base scores (stratified folds) train the meta model; bases
    are refitted on all rows for scoring. Every out-of-fold score comes from a
    base model that did not see that row."""

    def __init__(self, estimators: list, meta=None, fold_col: str = "fold", folds: int = 5,
                 label: str = "label"):
        self.estimators, self.fold_col, self.folds, self.label = estimators, fold_col, folds, label
        self.meta = meta or LogisticRegression(featuresCol="_meta", labelCol=label)

    def fit(self, df: DataFrame) -> "StackingModel":
        n = len(self.estimators)
        jobs = [(f, e) for f in [*range(self.folds), None] for e in self.estimators]
        models = side_by_side(lambda j: j[1].fit(df if j[0] is None else df.where(F.col(self.fold_col) != j[0])), jobs, df)
        parts = []
        for f in range(self.folds):
            out = df.where(F.col(self.fold_col) == f)
            for i in range(n):
                out = _base_score(models[f * n + i], out, i)
            parts.append(out)
        oof = reduce(lambda a, b: a.unionByName(b), parts)
        meta_in = VectorAssembler(inputCols=[f"s{i}" for i in range(n)], outputCol="_meta").transform(oof)
        meta = self.meta.fit(meta_in)
        return StackingModel(models[self.folds * n:], meta)


class StackingModel:
    def __init__(self, bases, meta):
        self.bases, self.meta = bases, meta

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for i, m in enumerate(self.bases):
            out = _base_score(m, out, i)
        out = VectorAssembler(inputCols=[f"s{i}" for i in range(len(self.bases))],
                              outputCol="_meta").transform(out)
        return self.meta.transform(out)


class Calibrate:
    """Platt scaling ('sigmoid': one-feature logistic regression on the score)
    or isotonic regression, fitted on out-of-fold scores. ``width``: features that the
    estimator makes of a row, which bounds the fits in flight."""

    def __init__(self, estimator, method: str = "sigmoid", fold_col: str = "fold", folds: int = 3,
                 label: str = "label", width: int = 20):
        self.estimator, self.method, self.width = estimator, method, width
        self.fold_col, self.folds, self.label = fold_col, folds, label

    def fit(self, df: DataFrame) -> "CalibratedModel":
        if isinstance(self.estimator, MappedSvm):  # the fits share their passes over the rows
            models = fit_folds([(self.estimator, f) for f in [*range(self.folds), None]], df, self.fold_col)
        else:
            models = side_by_side(lambda f: self.estimator.fit(df if f is None else df.where(F.col(self.fold_col) != f)),
                                  [*range(self.folds), None], df, width=self.width)
        parts = [_base_score(models[f], df.where(F.col(self.fold_col) == f), 0) for f in range(self.folds)]
        oof = reduce(lambda a, b: a.unionByName(b), parts)
        if self.method == "isotonic":
            cal = Isotonic("s0", self.label, "_iso").fit(oof)
        else:
            cal = LogisticRegression(featuresCol="_cal", labelCol=self.label).fit(
                VectorAssembler(inputCols=["s0"], outputCol="_cal").transform(oof))
        return CalibratedModel(models[-1], cal, self.method)


class CalibratedModel:
    def __init__(self, base, cal, method):
        self.base, self.cal, self.method = base, cal, method

    def transform(self, df: DataFrame) -> DataFrame:
        out = _base_score(self.base, df, 0)
        if self.method == "isotonic":
            return (self.cal.transform(out).withColumn("score", F.col("_iso"))
                    .withColumn("pred", (F.col("_iso") >= 0.5).cast("int")))
        out = self.cal.transform(VectorAssembler(inputCols=["s0"], outputCol="_cal").transform(out))
        return (out.withColumn("score", vector_to_array(F.col("probability"))[1])
                .withColumn("pred", F.col("prediction").cast("int")))
