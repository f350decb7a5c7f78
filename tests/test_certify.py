"""The certificates hold for optimal fits and fail for all others."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from riskframe.operators import certify as CE, models as MO


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    y = (x @ [1.0, -0.5, 0.0, 0.2] + rng.logistic(size=600) > 1.2).astype(float)
    data = [(Vectors.dense(a), float(b), 3.0 if b else 1.0) for a, b in zip(x, y)]
    return spark.createDataFrame(data, ["features", "label", "w"]).repartition(3).cache()


@pytest.mark.parametrize("C,weight", [(1.0, None), (0.01, None), (5.0, "w")])
def test_the_optimum_is_certified(rows, C, weight):
    s = CE.logistic_gap(MO.Logistic(C, weight_col=weight).fit(rows), rows, C, weight)
    assert 0 <= s["gap"] + 1e-12 and s["gap"] < 1e-6 and s["objective"] < s["constant"] and s["n_rows"] == 600


def test_wrong_fits_are_not(rows):
    for model in (MO.Logistic(0.001).fit(rows), MO.Logistic(1.0, weight_col="w").fit(rows), MO.Logistic(1.0, max_iter=1).fit(rows)):
        assert CE.logistic_gap(model, rows, 1.0)["gap"] > 1e-4
    constant = MO.Logistic(1e-9).fit(rows)
    s = CE.logistic_gap(constant, rows, 1.0)
    assert s["gap"] > 1e-3 and s["objective"] > s["constant"] * (1 - 1e-6)


def test_the_bound_is_below_every_objective(rows):
    best = CE.logistic_gap(MO.Logistic(1.0).fit(rows), rows, 1.0)
    for C in (0.003, 0.1, 30.0):
        s = CE.logistic_gap(MO.Logistic(C).fit(rows), rows, 1.0)
        assert s["bound"] <= best["objective"] + 1e-12 <= s["objective"] + 2e-12


def test_one_class_is_an_error(rows):
    model = MO.Logistic(1.0).fit(rows)
    with pytest.raises(ValueError):
        CE.logistic_gap(model, rows.where("label = 1"), 1.0)
