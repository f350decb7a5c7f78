import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import measures as M
from riskframe.operators import features as FE


def test_measures_and_flags(spark):
    df = spark.createDataFrame([("60Nm@3500rpm", "Yes"), ("40.36bhp@6000rpm", "No"), ("bad", "yes"),
                                (None, None)], "m string, f string")
    out = M.parse_measure(df, "m", "T").withColumn("f", M.yes_no_to_int("f")).collect()
    assert (out[0]["T"], out[0]["T_unit"], out[0]["T_rpm"], out[0]["f"]) == (60.0, "Nm", 3500.0, 1)
    assert (out[1]["T"], out[1]["T_unit"], out[1]["T_rpm"], out[1]["f"]) == (40.36, "bhp", 6000.0, 0)
    assert (out[2]["T"], out[2]["T_unit"], out[2]["T_rpm"], out[2]["f"]) == (None, "bad", None, None)
    assert (out[3]["T"], out[3]["T_unit"], out[3]["f"]) == (None, None, None)


def test_one_hot_null_and_unseen_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    m = FE.OneHot(["c"]).fit(train)
    assert m.output_columns() == ["c_a", "c_b"]
    out = m.transform(spark.createDataFrame([("a",), ("z",), (None,)], "c string")).collect()
    assert [(r["c_a"], r["c_b"]) for r in out] == [(1, 0), (0, 0), (0, 0)]


def test_standard_scale_population_sigma_and_zero(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)], "x double, k double")
    out = FE.StandardScale(["x", "k"]).fit(df).transform(df).collect()
    sd = np.std([1, 2, 3])
    assert out[0]["x"] == pytest.approx(-1 / sd) and out[0]["k"] == 0.0


def test_poly_terms_order_and_values(spark):
    t = FE.PolyFeatures(["a", "b"], 2)
    assert t.output_columns() == ["a", "b", "a_pow2", "a_x_b", "b_pow2"]
    r = t.transform(spark.createDataFrame([(2.0, 3.0)], "a double, b double")).first()
    assert (r["a_pow2"], r["a_x_b"], r["b_pow2"]) == (4.0, 6.0, 9.0)
    assert FE.Interactions(["a", "b", "c"]).output_columns() == ["a", "b", "c", "a_x_b", "a_x_c", "b_x_c"]


def test_anova_matches_formula(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=200)
    y = (rng.random(200) < 0.3).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int")
    f = FE.anova_f_scores(df, ["x"], "y").first()["f_score"]
    groups = [x[y == c] for c in (0, 1)]
    gm = x.mean()
    ssb = sum(len(g) * (g.mean() - gm) ** 2 for g in groups)
    ssw = sum(((g - g.mean()) ** 2).sum() for g in groups)
    assert f == pytest.approx((ssb / 1) / (ssw / (len(x) - 2)))


def test_pca_orthonormal_and_variance(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(300, 3)) @ np.array([[2, 0, 0], [1, 1, 0], [0, 0, 0.1]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    m = FE.CenteredPCA(["a", "b", "c"], k=2).fit(df)
    W = np.array(m.components)
    assert np.allclose(W @ W.T, np.eye(2), atol=1e-9)
    pcs = np.array([[r["PC1"], r["PC2"]] for r in m.transform(df).collect()])
    assert np.allclose(pcs.mean(0), 0, atol=1e-9)
    assert np.var(pcs[:, 0], ddof=1) == pytest.approx(m.explained_variance[0], rel=1e-6)
    assert all(W[i, np.argmax(np.abs(W[i]))] > 0 for i in range(2))


def test_select_k_best(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    rows = [(float(y[i] * 3 + rng.normal()), float(rng.normal()), int(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "good double, noise double, y int")
    m = FE.SelectKBest(["good", "noise"], "y", k=1).fit(df)
    assert m.selected == ["good"]


def test_anova_of_many_features_is_one_narrow_aggregate(spark):
    cols = [f"x{i}" for i in range(43)]
    df = spark.range(300).select((F.col("id") % 3).alias("y"), *[
        F.when(F.col("id") % (i + 2) != 0, (F.col("id") * (i + 3)) % (11 + i)).cast("double").alias(c) for i, c in enumerate(cols)])
    found = FE.anova_f_scores(df, cols, "y")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("var_pop(") <= 2 * FE.ANOVA_WIDTH  # read twice
    f = {r["feature"]: r["f_score"] for r in found.collect()}
    assert sorted(f) == sorted(cols)
    p = df.toPandas()
    for c in cols:
        groups = [g[c].dropna() for _, g in p.groupby("y") if g[c].notna().any()]
        n, mean = sum(map(len, groups)), p[c].mean()
        between = sum(len(g) * (g.mean() - mean) ** 2 for g in groups) / (len(groups) - 1)
        inside = sum(((g - g.mean()) ** 2).sum() for g in groups) / (n - len(groups))
        assert f[c] == (pytest.approx(between / inside, rel=1e-9, abs=1e-12) if inside else None)
