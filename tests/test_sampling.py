import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import sampling as SA


def _frame(spark, n=200, pos=13, parts=3):
    rows = [(f"id{i}", float(i % 17), float((i * 7) % 11), 1 if i < pos else 0) for i in range(n)]
    return spark.createDataFrame(rows, "id string, x1 double, x2 double, label int").repartition(parts)


def test_kfold_stratified_complete_and_partition_independent(spark):
    a = {r["id"]: r["fold"] for r in SA.stratified_kfold(_frame(spark, parts=3), "id", "label", 5).collect()}
    b = {r["id"]: r["fold"] for r in SA.stratified_kfold(_frame(spark, parts=7), "id", "label", 5).collect()}
    assert a == b and len(a) == 200
    pos = [a[f"id{i}"] for i in range(13)]
    counts = np.bincount(pos, minlength=5)
    assert counts.max() - counts.min() <= 1
    neg = np.bincount([a[f"id{i}"] for i in range(13, 200)], minlength=5)
    assert neg.max() - neg.min() <= 1


def test_split_exact_size(spark):
    s = SA.train_test_split(_frame(spark), "id", 0.3, 17)
    assert s.where(F.col("split") == "test").count() == 60


def test_stratified_sample_sizes(spark):
    s = SA.stratified_sample(_frame(spark), "id", "label", 0.3)
    got = {r["label"]: r["count"] for r in s.groupBy("label").count().collect()}
    assert got == {1: 4, 0: 56}


def test_smote_parity_and_segments(spark):
    df = _frame(spark)
    out = SA.smote(df, "id", "label", ["x1", "x2"], k=5, strategy=1.0)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {0: 187, 1: 187}
    mino = np.array([(r["x1"], r["x2"]) for r in df.where("label = 1").collect()])
    syn = np.array([(r["x1"], r["x2"]) for r in out.where(F.col("id").contains("_syn")).collect()])
    assert len(syn) == 174
    # every synthetic point lies on a segment between two minority points
    ok = 0
    for p in syn:
        found = False
        for a in mino:
            for b in mino:
                d = b - a
                t = np.dot(p - a, d) / np.dot(d, d) if np.dot(d, d) > 0 else 0.0
                if -1e-9 <= t <= 1 + 1e-9 and np.allclose(a + t * d, p, atol=1e-9):
                    found = True
                    break
            if found:
                break
        ok += found
    assert ok == len(syn)


def test_smote_in_folds_equals_smote_of_each_training_set(spark):
    import random
    rng = random.Random(2)
    rows = [(f"p{i}", int(i % 5 == 0), rng.random() + 1000 * (i % 3), rng.random(), i % 3) for i in range(150)]
    df = spark.createDataFrame(rows, "id string, y int, a double, b double, fold int").repartition(3)
    got = SA.smote_in_folds(df, "id", "y", ["a", "b"], "fold", k=3).collect()
    by_fold = {e: sorted((r["id"], round(r["a"], 9), round(r["b"], 9)) for r in got if r["excluded"] == e) for e in range(3)}
    for e in (2,):
        train = df.where(f"fold <> {e}").drop("fold")
        want = SA.smote(train, "id", "y", ["a", "b"], k=3).where("id like '%_syn%'").collect()
        assert by_fold[e] == sorted((r["id"], round(r["a"], 9), round(r["b"], 9)) for r in want) and by_fold[e]
        # no synthetic point comes from a held-out row
        assert not {i.split("_syn")[0] for i, _, _ in by_fold[e]} & {r[0] for r in rows if r[4] == e}
        assert all(not 1000 * e <= a <= 1000 * e + 1 for _, a, _ in by_fold[e])
    with pytest.raises(ValueError):
        SA.smote_in_folds(df, "id", "y", ["a", "b"], "fold", k=25)


def _policies_file(spark, tmp_path):
    rows = [(None if i == 1 else f"p{i}", int(i % 6 == 0), float(i * i % 97), float(i * 7 % 31)) for i in range(120)]
    path = str(tmp_path / "rows.parquet")
    spark.createDataFrame(rows, "id string, y int, a double, b double").write.parquet(path)
    return spark.read.parquet(path), path


def test_synthetic_rows_of_folds_come_from_the_written_minority(spark, tmp_path):
    """The join, the cuts and the result do not read all rows again."""
    df, path = _policies_file(spark, tmp_path)
    folds = SA.stratified_kfold(df.where("id is not null"), "id", "y", 5, 17)
    made = SA.smote_in_folds(folds, "id", "y", ["a", "b"], "fold", k=3)
    assert not [f for f in made.inputFiles() if path in f]
    assert made.count() == made.select("excluded", "id").distinct().count() > 0


def test_smote_keeps_the_rows_asked_for(spark, tmp_path):
    df, _ = _policies_file(spark, tmp_path)
    whole = SA.smote(df, "id", "y", ["a", "b"], k=3)
    some = SA.smote(df, "id", "y", ["a", "b"], k=3, keep=F.col("id").isNull())
    added = whole.join(df.select("id"), "id", "left_anti")
    assert sorted(map(str, some.collect())) == sorted(map(str, added.collect()))
    assert whole.count() == some.count() + 119
