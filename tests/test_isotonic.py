"""Isotonic regression against the max-min formula."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.operators import isotonic as IS


def max_min(rows):
    xs = sorted({x for x, _ in rows})
    n = [sum(1 for x, _ in rows if x == v) for v in xs]
    y = [sum(t for x, t in rows if x == v) for v in xs]
    out = {}
    for i, v in enumerate(xs):
        out[v] = max(min(sum(y[j:k + 1]) / sum(n[j:k + 1]) for k in range(i, len(xs))) for j in range(i + 1))
    return out


@pytest.mark.parametrize("seed, distinct", [(1, 40), (2, 12), (3, 1)])
def test_equals_the_max_min_formula(spark, seed, distinct):
    r = random.Random(seed)
    rows = [(r.randrange(distinct) / distinct, float(r.random() < 0.4)) for _ in range(150)]
    df = spark.createDataFrame(rows, "score double, label double").repartition(5)
    blocks = IS.isotonic_blocks(df).orderBy("lo").collect()
    assert sum(b["n"] for b in blocks) == 150 and sum(b["y"] for b in blocks) == sum(t for _, t in rows)
    assert all(a["value"] < b["value"] and a["hi"] < b["lo"] for a, b in zip(blocks, blocks[1:]))
    wanted = max_min(rows)
    for limit in (IS.KNOTS, 0):  # by broadcast, and by a running count
        got = IS.Isotonic(limit=limit).fit(df).transform(df).collect()
        assert len(got) == 150 and all(x["calibrated"] == pytest.approx(wanted[x["score"]]) for x in got)


def test_between_and_beyond_the_blocks(spark):
    df = spark.createDataFrame([(0.2, 0.0), (0.4, 1.0), (0.6, 0.0), (0.8, 1.0), (None, 1.0), (float("nan"), 1.0), (0.1, None)],
                               "score double, label double")
    new = spark.createDataFrame([(1, 0.0), (2, 0.3), (3, 0.5), (4, 0.7), (5, 2.0), (6, None), (7, float("nan"))], "id long, score double")
    wanted = {1: 0.0, 2: 0.25, 3: 0.5, 4: 0.75, 5: 1.0, 6: None, 7: None}
    for limit in (IS.KNOTS, 0):
        out = IS.Isotonic(limit=limit).fit(df).transform(new)
        assert out.columns == ["id", "score", "calibrated"]
        got = {r["id"]: r["calibrated"] for r in out.collect()}
        assert {i: v if v is None else round(v, 9) for i, v in got.items()} == wanted
    with pytest.raises(ValueError):
        IS.Isotonic().fit(df.where("score > 5"))


def test_calibrate_equals_the_curve_of_held_out_scores(spark):
    from pyspark.ml.regression import IsotonicRegression
    from pyspark.ml.feature import VectorAssembler
    r = random.Random(4)
    df = spark.createDataFrame([(r.random(), float(r.random() < 0.3)) for _ in range(200)], "s double, label double")
    mine = IS.Isotonic("s").fit(df).transform(df).select("s", "calibrated")
    vec = VectorAssembler(inputCols=["s"], outputCol="v").transform(df)
    theirs = IsotonicRegression(featuresCol="v").fit(vec).transform(vec).select("s", F.col("prediction").alias("p"))
    assert mine.join(theirs, "s").where(F.abs(F.col("calibrated") - F.col("p")) > 1e-9).count() == 0
