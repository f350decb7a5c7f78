"""Out-of-fold scores, and strict reading."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import models as MO, oof as OO
from riskframe.sources.tables import read_strict


class Memory:
    """Scores 1 for the keys that it was fitted on."""

    def fit(self, df):
        self.seen = [r["id"] for r in df.select("id").collect()]
        return self

    def transform(self, df):
        return df.withColumn("score", F.col("id").isin(self.seen).cast("double")).withColumn("pred", F.lit(0))


def test_no_score_comes_from_a_model_that_saw_the_row(spark):
    df = spark.createDataFrame([(i, i % 4, float(i % 3 == 0)) for i in range(80)], "id long, fold int, label double")
    extra = spark.createDataFrame([(1000 + f, f, 1.0) for f in range(4)], "id long, excluded int, label double")
    oof = OO.out_of_fold({"a": Memory(), "b": Memory()}, df, "id", [0, 1, 2, 3], synthetic=extra)
    rows = oof.collect()
    assert len(rows) == 160 and {r["score"] for r in rows} == {0.0}
    assert sorted((r["id"], r["fold"]) for r in rows if r["model"] == "a") == [(i, i % 4) for i in range(80)]
    wide = OO.wide_scores(oof, "id", ["a", "b"]).collect()
    assert len(wide) == 80 and {(r["s0"], r["s1"]) for r in wide} == {(0.0, 0.0)}


class Fixed:
    def __init__(self, column):
        self.column = column

    def fit(self, df):
        return self

    def transform(self, df):
        return df.withColumn("score", F.col(self.column)).withColumn("pred", F.lit(0))


def test_thresholds_come_from_validation_and_metrics_from_test(spark):
    rows = [(i, i % 2, float(i % 5 == 0), (i % 5 == 0) * 0.5 + (i % 7) / 20, (i * 37 % 80) / 80) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, fold int, label double, good double, noise double")
    models = {"good": Fixed("good"), "noise": Fixed("noise")}
    oof = OO.out_of_fold(models, df.where("id < 40"), "id", [0, 1])
    chosen = OO.chosen_thresholds(oof)
    thr = {r["model"]: r["best_threshold"] for r in chosen.collect()}
    got = {r["model"]: r for r in OO.report(models, chosen, df.where("id < 40"), df.where("id >= 40"), "id").collect()}
    assert got["good"]["f1_1"] == 1.0 and got["good"]["n"] == 40
    for m, at in (("good", 3), ("noise", 4)):
        test = [(r[2], r[at] >= thr[m]) for r in rows if r[0] >= 40]
        tp = sum(1 for y, p in test if y and p)
        assert got[m]["threshold"] == thr[m] and got[m]["recall_1"] == pytest.approx(tp / sum(1 for y, _ in test if y))
        assert got[m]["accuracy"] == pytest.approx(sum(bool(y) == p for y, p in test) / 40)


def test_strict_reading_parts_bad_lines(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,_line\n1,x,p\nmany,y,q\n2,z\n3,\"w,w\",r\n4,v,s,t\n,u,\n")
    rows, rejected = read_strict(spark, str(path), "a int, b string, _line string")
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, "x", "p"), (3, "w,w", "r"), (None, "u", None)]
    assert sorted(r["line"] for r in rejected.collect()) == ["2,z", "4,v,s,t", "many,y,q"]
    path.write_text("a,b\n")
    rows, rejected = read_strict(spark, str(path), "a int, b string")
    assert rows.count() == 0 and rejected.count() == 0


class Weights:
    def fit(self, df):
        self.seen = {r["label"]: r["w"] for r in df.select("label", "w").distinct().collect()}
        return self


def test_weights_come_from_the_training_rows(spark):
    from riskframe.operators.sampling import WeighThenFit
    df = spark.createDataFrame([(i, float(i % 4 == 0), 99.0) for i in range(40)], "id long, label double, w double")
    assert WeighThenFit(Weights()).fit(df).seen == {1.0: 2.0, 0.0: 40 / 60}
    assert WeighThenFit(Weights()).fit(df.where("id < 4 or id % 4 = 0")).seen == {1.0: 13 / 20, 0.0: 13 / 6}


def test_soft_voting_takes_members_with_a_score(spark):
    from pyspark.ml.feature import VectorAssembler
    from riskframe.operators import ensemble as EN
    df = spark.createDataFrame([(i, float(i % 10), i % 3 / 2, int(i % 10 > 5)) for i in range(60)], "id long, a double, b double, label int")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    members = [MO.GaussianNb(["a", "b"], "label"), MO.Logistic(1.0)]
    out = EN.Voting(members, "soft").fit(df).transform(df)
    rows = {r["id"]: r for r in out.collect()}
    nb = {r["id"]: r["score"] for r in members[0].fit(df).transform(df).collect()}
    assert all(abs(r["s0"] - nb[i]) < 1e-12 and abs(r["score"] - (r["s0"] + r["s1"]) / 2) < 1e-12 for i, r in rows.items())
    assert sum(r["pred"] == r["label"] for r in rows.values()) >= 54
    hard = EN.Voting(members, "hard").fit(df).transform(df).collect()
    assert all(r["pred"] == int(r["p0"] + r["p1"] > 1) for r in hard)
