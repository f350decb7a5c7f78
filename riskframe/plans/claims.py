"""The claim-prediction workflow: clean -> split -> fit features on the
training rows only -> train / tune / combine models -> metrics.

Fixes the reference's defects: every statistic is fitted on the training split
(no leakage), each step is a fitted model applicable to any frame, thresholds
are chosen on out-of-fold scores (``operators.oof``).
"""

from __future__ import annotations

import time

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.measures import parse_measure, yes_no_to_int
from riskframe.operators import evaluate as EV
from riskframe.operators import features as FE
from riskframe.operators.models import scored
from riskframe.operators.sampling import stratified_kfold, train_test_split
from riskframe.session import dealt, written
from riskframe.sources.tables import KEY, LABEL, policies

CATEGORIES = ["area_cluster", "segment", "Torque_unit", "Power_unit"]
OUTLIERS = ["age_of_car", "age_of_policyholder", "policy_tenure"]
SCALED = ["policy_tenure", "age_of_policyholder", "age_of_car", "n_lines", "qty", "price", "disc",
          "Torque", "Torque_rpm", "Power", "Power_rpm"]
SIZE = ["n_lines", "qty", "price", "disc"]
# orders without lines have no quantities: zero, not missing, for the models
ZERO_IF_MISSING = ["qty", "price", "disc", "Torque", "Torque_rpm", "is_esc"]


def cleaned(df: DataFrame) -> DataFrame:
    """Flags to 0/1, measure strings to numbers and units."""
    df = df.withColumn("is_esc", yes_no_to_int("is_esc"))
    df = parse_measure(parse_measure(df, "max_torque", "Torque"), "max_power", "Power")
    return df.fillna(0, subset=ZERO_IF_MISSING)


def feature_stages(k: int = 20) -> Pipeline:
    return Pipeline(stages=[
        FE.OneHot(CATEGORIES), FE.OutlierToMedian(OUTLIERS), FE.StandardScale(SCALED),
        FE.CenteredPCA(SIZE, 2), FE.SelectKBest(None, LABEL, k, keep=[KEY, "PC1", "PC2"]),
        FE.AssembleAll([KEY, LABEL])])


def model_frame(df: DataFrame) -> DataFrame:
    return df.select(KEY, F.col(LABEL).cast("double").alias("label"), "features")


def prepared(spark: SparkSession, sf_dir: str, k: int = 20, seed: int = 17):
    """(train, test, feature_model): assembled frames, fitted on train only,
    cached because every model reads them many times. The joined rows are written once:
    the split and every statistic of the features read them again."""
    data = written(cleaned(policies(spark, sf_dir)), "policies")
    split = train_test_split(data, KEY, 0.3, seed)
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    fmodel = feature_stages(k).fit(train)
    tr = dealt(model_frame(fmodel.transform(train)))
    te = dealt(model_frame(fmodel.transform(test)))
    return tr, te, fmodel


def with_folds(tr: DataFrame, folds: int = 5, seed: int = 17) -> DataFrame:
    return stratified_kfold(tr, KEY, "label", folds, seed).cache()


def metrics_row(spark, name: str, scored_df: DataFrame, fit_s: float) -> DataFrame:
    m = EV.binary_metrics(scored_df).select("accuracy", "precision_1", "recall_1", "f1_1")
    return m.select(F.lit(name).alias("model"), F.lit(float(fit_s)).alias("fit_s"), "*")


def evaluate_estimator(spark, name: str, est, tr: DataFrame, te: DataFrame) -> DataFrame:
    t0 = time.perf_counter()
    model = est.fit(tr)
    fit_s = time.perf_counter() - t0
    return metrics_row(spark, name, scored(model, te, KEY), fit_s)


def as_vectors(df: DataFrame) -> DataFrame:
    return df.withColumn("vec", vector_to_array(F.col("features")))
