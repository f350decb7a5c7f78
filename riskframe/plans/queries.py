"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the whole driver tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import frames, profile, compare
from riskframe.plans.common import (PROFILE_COLUMNS, STRING_COLUMNS, policies, rounded,
                                    train_test_tables)
from riskframe.sources.tables import KEY, LABEL, NUMERIC_COLUMNS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --- sources, inspection, projection -------------------------------------

@query("shape")
def q_shape(spark, sf):
    return frames.shape(policies(spark, sf))


@query("schema_frame")
def q_schema_frame(spark, sf):
    return frames.schema_frame(policies(spark, sf))


@query("head")
def q_head(spark, sf):
    return rounded(frames.head(policies(spark, sf), 5, by=KEY))


@query("drop_columns")
def q_drop_columns(spark, sf):
    return rounded(frames.drop_columns(policies(spark, sf), ["max_torque", "max_power"]))


@query("select_dtypes")
def q_select_dtypes(spark, sf):
    return rounded(frames.select_dtypes(policies(spark, sf), "number"))


@query("move_last")
def q_move_last(spark, sf):
    return rounded(frames.move_last(policies(spark, sf).select(KEY, LABEL, "segment", "qty"),
                                    LABEL))


# --- profiling ---------------------------------------------------------------

@query("null_counts")
def q_null_counts(spark, sf):
    return profile.null_counts(policies(spark, sf))


@query("duplicate_count")
def q_duplicate_count(spark, sf):
    return profile.duplicate_count(frames.drop_columns(policies(spark, sf), [KEY]))


@query("unique_counts")
def q_unique_counts(spark, sf):
    return profile.unique_counts(policies(spark, sf))


@query("describe")
def q_describe(spark, sf):
    return rounded(profile.describe(policies(spark, sf), PROFILE_COLUMNS))


@query("numeric_profile")
def q_numeric_profile(spark, sf):
    return rounded(profile.numeric_profile(policies(spark, sf), PROFILE_COLUMNS))


@query("value_counts")
def q_value_counts(spark, sf):
    return rounded(profile.value_counts(policies(spark, sf), "area_cluster", normalize=True))


@query("top_categories")
def q_top_categories(spark, sf):
    train, test = train_test_tables(spark, sf)
    return rounded(compare.concat_results(
        [profile.top_categories(train, 5, STRING_COLUMNS),
         profile.top_categories(test, 5, STRING_COLUMNS)], ["train", "test"], "frame"))


@query("group_rate")
def q_group_rate(spark, sf):
    return rounded(profile.group_rate(policies(spark, sf), LABEL, STRING_COLUMNS))


@query("correlation_matrix")
def q_correlation_matrix(spark, sf):
    return rounded(profile.correlation_matrix(policies(spark, sf), PROFILE_COLUMNS))


@query("histogram")
def q_histogram(spark, sf):
    return rounded(profile.histogram(policies(spark, sf), NUMERIC_COLUMNS, bins=30))


@query("kde")
def q_kde(spark, sf):
    train, test = train_test_tables(spark, sf)
    return rounded(compare.concat_results(
        [profile.kde(train, NUMERIC_COLUMNS, grid=50), profile.kde(test, NUMERIC_COLUMNS, grid=50)],
        ["train", "test"], "frame"))


@query("class_balance")
def q_class_balance(spark, sf):
    return rounded(profile.class_balance(policies(spark, sf), LABEL))


@query("balance_ratio")
def q_balance_ratio(spark, sf):
    return rounded(profile.balance_ratio(policies(spark, sf), LABEL))


@query("class_weights")
def q_class_weights(spark, sf):
    return rounded(profile.class_weights_balanced(policies(spark, sf), LABEL))


# --- two-table comparison ---------------------------------------------------

@query("compare_profiles")
def q_compare_profiles(spark, sf):
    train, test = train_test_tables(spark, sf)
    return compare.compare_profiles(profile.unique_counts(train), profile.unique_counts(test),
                                    on="column", names=("train", "test"))


@query("category_diff")
def q_category_diff(spark, sf):
    train, test = train_test_tables(spark, sf)
    return compare.category_diff(train, test, STRING_COLUMNS)


# --- scalar cleaning and fitted features -------------------------------------

from riskframe.functions import measures as M  # noqa: E402
from riskframe.functions.numeric import abs_round  # noqa: E402
from riskframe.operators import features as FE, sampling as SA, evaluate as EV  # noqa: E402
from riskframe.session import written  # noqa: E402
from riskframe.plans.common import fixture_score, scored_fixture  # noqa: E402

OUTLIER_COLUMNS = ["age_of_car", "age_of_policyholder", "policy_tenure"]
SCALE_COLUMNS = NUMERIC_COLUMNS
POLY_COLUMNS = NUMERIC_COLUMNS
INTERACTION_COLUMNS = NUMERIC_COLUMNS
ONE_HOT_COLUMNS = ["area_cluster", "segment", "is_esc"]
ANOVA_COLUMNS = NUMERIC_COLUMNS


@query("yes_no_to_int")
def q_yes_no(spark, sf):
    return policies(spark, sf).select(KEY, M.yes_no_to_int("is_esc").alias("is_esc"))


@query("parse_measure")
def q_parse_measure(spark, sf):
    p = policies(spark, sf).select(KEY, "max_torque", "max_power")
    p = M.parse_measure(M.parse_measure(p, "max_torque", "Torque"), "max_power", "Power")
    return rounded(p)


@query("one_hot")
def q_one_hot(spark, sf):
    p = policies(spark, sf)
    model = FE.OneHot(ONE_HOT_COLUMNS).fit(p)
    cols = model.output_columns()
    return model.transform(p).select(KEY, *cols).unpivot([KEY], cols, "feature", "value")


@query("bool_to_int")
def q_bool_to_int(spark, sf):
    p = policies(spark, sf).select(KEY, (F.col("n_lines") >= 4).alias("many_lines"))
    return frames.bool_to_int(p)


@query("outlier_to_median")
def q_outlier_to_median(spark, sf):
    p = policies(spark, sf)
    model = FE.OutlierToMedian(OUTLIER_COLUMNS).fit(p)
    return rounded(model.transform(p).select(KEY, *OUTLIER_COLUMNS))


@query("outlier_rows")
def q_outlier_rows(spark, sf):
    p = policies(spark, sf)
    return profile.outlier_rows(p, profile.fences(p, OUTLIER_COLUMNS))


@query("outlier_filter")
def q_outlier_filter(spark, sf):
    p = policies(spark, sf)
    kept = profile.outlier_filter(p, profile.fences(p, OUTLIER_COLUMNS))
    return rounded(kept.select(KEY, *OUTLIER_COLUMNS))


@query("standard_scale")
def q_standard_scale(spark, sf):
    p = policies(spark, sf)
    out = FE.StandardScale(SCALE_COLUMNS).fit(p).transform(p)
    return out.select(KEY, *[abs_round(c).alias(c) for c in SCALE_COLUMNS])


@query("poly_features")
def q_poly_features(spark, sf):
    t = FE.PolyFeatures(POLY_COLUMNS, 2)
    return rounded(t.transform(policies(spark, sf)).select(KEY, *t.output_columns()))


@query("interaction_features")
def q_interaction_features(spark, sf):
    t = FE.Interactions(INTERACTION_COLUMNS)
    return rounded(t.transform(policies(spark, sf)).select(KEY, *t.output_columns()))


@query("anova_f_scores")
def q_anova(spark, sf):
    return rounded(FE.anova_f_scores(policies(spark, sf), ANOVA_COLUMNS, LABEL))


@query("select_k_best")
def q_select_k_best(spark, sf):
    model = FE.SelectKBest(ANOVA_COLUMNS, LABEL, k=3, keep=[KEY]).fit(policies(spark, sf))
    return spark.createDataFrame([(i + 1, f) for i, f in enumerate(model.selected)],
                                 "rank int, feature string")


@query("pca")
def q_pca(spark, sf):
    p = policies(spark, sf).fillna(0, subset=["qty", "price", "disc"])
    model = FE.CenteredPCA(["n_lines", "qty", "price", "disc"], k=2).fit(p)
    return model.transform(p).select(KEY, "PC1", "PC2")


@query("hstack_by_key")
def q_hstack(spark, sf):
    p = policies(spark, sf)
    scaled = FE.StandardScale(["policy_tenure"]).fit(p).transform(p).select(
        KEY, abs_round("policy_tenure").alias("policy_tenure"))
    return compare.hstack_by_key([p.select(KEY, "segment", LABEL), scaled], KEY)


# --- splits -------------------------------------------------------------------

@query("train_test_split")
def q_train_test_split(spark, sf):
    return SA.train_test_split(policies(spark, sf).select(KEY, LABEL), KEY, 0.3, 17)


@query("stratified_kfold")
def q_stratified_kfold(spark, sf):
    return SA.stratified_kfold(policies(spark, sf).select(KEY, LABEL), KEY, LABEL, 5, 17)


@query("stratified_sample")
def q_stratified_sample(spark, sf):
    return SA.stratified_sample(policies(spark, sf).select(KEY, LABEL), KEY, LABEL, 0.3, 17)


# --- evaluation on a deterministic score -----------------------------------------

SWEEP = [0.5, 0.45, 0.4, 0.35, 0.3]


@query("confusion_matrix")
def q_confusion(spark, sf):
    return EV.confusion_matrix(EV.at_threshold(scored_fixture(spark, sf), 0.5))


@query("binary_metrics")
def q_binary_metrics(spark, sf):
    return rounded(EV.binary_metrics(EV.at_threshold(scored_fixture(spark, sf), 0.5)))


@query("classification_report")
def q_report(spark, sf):
    return rounded(EV.classification_report(EV.at_threshold(scored_fixture(spark, sf), 0.5)))


@query("roc_curve")
def q_roc(spark, sf):
    return rounded(EV.roc_curve(scored_fixture(spark, sf)))


@query("auc")
def q_auc(spark, sf):
    return rounded(EV.auc(scored_fixture(spark, sf)))


@query("pr_curve")
def q_pr(spark, sf):
    return rounded(EV.pr_curve(scored_fixture(spark, sf)))


@query("eval_at_threshold")
def q_eval_at_threshold(spark, sf):
    return rounded(EV.eval_at_threshold(scored_fixture(spark, sf), 0.4))


@query("threshold_for_target_recall")
def q_target_recall(spark, sf):
    return rounded(EV.threshold_for_target_recall(scored_fixture(spark, sf), 0.70, 0.50))


@query("sweep_thresholds")
def q_sweep(spark, sf):
    return rounded(EV.sweep_thresholds(scored_fixture(spark, sf), SWEEP))


@query("best_f1_threshold")
def q_best_f1(spark, sf):
    return rounded(EV.best_f1_threshold(scored_fixture(spark, sf)))


@query("model_comparison")
def q_model_comparison(spark, sf):
    s = scored_fixture(spark, sf)
    rows = [EV.eval_at_threshold(s, t).withColumn("model", F.lit(f"score@{t}")) for t in (0.5, 0.3)]
    return rounded(EV.model_comparison(rows))


N_MODELS = 9


def _nine_scores(spark, sf):
    """Nine deterministic scores per row as a long frame (model, label, score)."""
    from riskframe.functions.hashing import uniform_hash
    p = policies(spark, sf)
    score = [(F.floor(uniform_hash(KEY, 20 + i) * 40 * (i + 1)) + F.col(LABEL) * i * 5) / (40 * (i + 1) + 40) for i in range(N_MODELS)]
    models = F.array(*[F.struct(F.lit(f"m{i}").alias("model"), s.alias("score")) for i, s in enumerate(score)])
    return p.select(F.col(LABEL).alias("label"), F.explode(models).alias("m")).select("m.model", "label", "m.score")


@query("model_curves")
def q_model_curves(spark, sf):
    """ROC and precision-recall points of nine models from one running count."""
    return rounded(EV.model_curves(_nine_scores(spark, sf)))


@query("curve_summary")
def q_curve_summary(spark, sf):
    return rounded(EV.curve_summary(EV.model_curves(_nine_scores(spark, sf))))


@query("attach_bounds")
def q_attach_bounds(spark, sf):
    """Each row with the mean and largest price of its area."""
    p = policies(spark, sf).select(KEY, "area_cluster", "price")
    bounds = p.groupBy("area_cluster").agg(F.avg("price").alias("mean_price"), F.max("price").alias("max_price"))
    return rounded(compare.attach_bounds(p, bounds, "area_cluster"))


@query("if_column")
def q_if_column(spark, sf):
    """Steps that run only where their column exists: one does, one does not."""
    p = policies(spark, sf).select(KEY, LABEL, "segment", "n_lines")
    p = frames.if_column(p, "n_lines", lambda d: d.withColumn("many_lines", (F.col("n_lines") >= 4).cast("int")))
    return frames.if_column(p, "no_such_column", lambda d: d.drop("segment"))


@query("concat_results")
def q_concat_results(spark, sf):
    s = scored_fixture(spark, sf)
    return rounded(compare.concat_results(
        [EV.sweep_thresholds(s, [0.5, 0.4]), EV.binary_metrics(EV.at_threshold(s, 0.3))],
        ["sweep", "single"], "group"))


# --- models, resampling, tuning, ensembles, streaming ------------------------------

from riskframe.operators import certify as CE, ensemble as EN, knn as KN, models as MO, oof as OO, tuning as TU  # noqa: E402
from riskframe.plans import claims as CL  # noqa: E402
from riskframe.session import one_per_slot, read_dealt, written  # noqa: E402


def _prepared(spark, sf):
    return CL.prepared(spark, sf)


def _balanced(tr):
    return profile.with_class_weights(tr, "label", "w")


@query("logistic")
def q_logistic(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "logistic", MO.Logistic(C=1.0), tr, te)


@query("logistic_poly")
def q_logistic_poly(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PolynomialExpansion
    tr, te, _ = _prepared(spark, sf)
    est = Pipeline(stages=[PolynomialExpansion(degree=2, inputCol="features", outputCol="_poly"),
                           MO.Logistic(C=1.0, features="_poly")])
    return CL.evaluate_estimator(spark, "logistic_poly", est, tr, te)


def _interactions(df):
    from pyspark.ml.functions import vector_to_array as v2a
    names = [f"f{i}" for i in range(len(df.first()["features"]))]
    inter = FE.Interactions(names)
    arr = df.withColumns({n: v2a(F.col("features"))[i] for i, n in enumerate(names)})
    return FE.assemble(inter.transform(arr), inter.output_columns(), "_int").select(KEY, "label", "_int")


@query("logistic_interactions")
def q_logistic_interactions(spark, sf):
    """Interaction-only degree-2 terms of the selected features + scaling + LR."""
    tr, te, _ = _prepared(spark, sf)
    a, b = _interactions(tr), _interactions(te)  # inputs were standardised upstream
    return CL.evaluate_estimator(spark, "logistic_interactions", MO.Logistic(C=1.0, features="_int"), a, b)


@query("logistic_balanced")
def q_logistic_balanced(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "logistic_balanced", MO.Logistic(C=1.0, weight_col="w"),
                                 _balanced(tr), te)


CERTIFIED = 1e-4  # largest proven gap, as a share of the objective
GRID_C = [0.1, 0.5, 1.0, 5.0]


def _certified(spark, name, rows, C=1.0, weight=None, features="features"):
    model = MO.Logistic(C=C, weight_col=weight, features=features).fit(rows)
    return CE.certificate(spark, name, CE.logistic_gap(model, rows, C, weight, features), CERTIFIED)


@query("certify_logistic")
def q_certify_logistic(spark, sf):
    """Proof from the training rows that the fit of ``logistic`` is the optimum."""
    return _certified(spark, "logistic", _prepared(spark, sf)[0])


@query("certify_logistic_balanced")
def q_certify_logistic_balanced(spark, sf):
    return _certified(spark, "logistic_balanced", _balanced(_prepared(spark, sf)[0]), weight="w")


@query("certify_logistic_poly")
def q_certify_logistic_poly(spark, sf):
    from pyspark.ml.feature import PolynomialExpansion
    rows = PolynomialExpansion(degree=2, inputCol="features", outputCol="_poly").transform(_prepared(spark, sf)[0])
    return _certified(spark, "logistic_poly", rows.select("label", "_poly").persist(), features="_poly")


@query("certify_logistic_interactions")
def q_certify_logistic_interactions(spark, sf):
    return _certified(spark, "logistic_interactions", _interactions(_prepared(spark, sf)[0]).persist(), features="_int")


@query("certify_logistic_grid")
def q_certify_grid(spark, sf):
    """Each C of the tuning grid, plain and balanced."""
    tr, _, _ = _prepared(spark, sf)
    b = _balanced(tr)
    rows = [_certified(spark, f"{kind} C={c}", b, c, weight) for kind, weight in (("plain", None), ("balanced", "w")) for c in GRID_C]
    return reduce(DataFrame.unionByName, rows)


@query("decision_tree")
def q_decision_tree(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "decision_tree", MO.Tree("gini", None), one_per_slot(tr), te)


@query("random_forest")
def q_random_forest(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "random_forest",
                                 MO.Forest(200, 5, "entropy", weight_col="w"), _balanced(tr), te)


@query("gaussian_nb_spark")
def q_gaussian_nb_spark(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "gaussian_nb_spark", MO.SparkGaussianNb(), tr, te)


NB_COLUMNS = NUMERIC_COLUMNS


@query("gaussian_nb")
def q_gaussian_nb(spark, sf):
    """Naive Bayes as DataFrame operations, on raw columns of the hash split."""
    s = SA.train_test_split(policies(spark, sf).select(KEY, LABEL, *NB_COLUMNS), KEY, 0.3, 17)
    train = s.where(F.col("split") == "train")
    test = s.where(F.col("split") == "test")
    model = MO.GaussianNb(NB_COLUMNS, LABEL).fit(train)
    return rounded(model.transform(test).select(KEY, "pred", "score"))


@query("svm_linear")
def q_svm_linear(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "svm_linear", MO.LinearSvm(C=1.0), tr, te)


@query("svm_poly")
def q_svm_poly(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "svm_poly", MO.PolySvm(C=1.0, degree=3), tr, te)


@query("svm_rbf")
def q_svm_rbf(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "svm_rbf", MO.RbfSvm(C=1.0, gamma="scale"), tr, te)


def _svm_probability(spark, sf, kind, machine, width=20):
    """Probabilities of a machine by Platt scaling of its out-of-fold margins. ``width``: features
    that it makes of a row, or a function of the training rows that tells."""
    tr, te, _ = _prepared(spark, sf)
    width = width(tr) if callable(width) else width
    model, fit_s = EV.timed_fit(EN.Calibrate(machine, "sigmoid", folds=3, width=width), CL.with_folds(tr, 3))
    out = model.transform(te).select(KEY, F.col("label").cast("int").alias("label"), "score", "pred")
    return CL.metrics_row(spark, kind, out, fit_s)


@query("svm_probability")
def q_svm_probability(spark, sf):
    return _svm_probability(spark, sf, "svm_probability", MO.LinearSvm(C=1.0))


@query("svm_probability_poly")
def q_svm_probability_poly(spark, sf):
    return _svm_probability(spark, sf, "svm_probability_poly", MO.PolySvm(C=1.0, degree=3), MO.poly_width)


@query("svm_probability_rbf")
def q_svm_probability_rbf(spark, sf):
    return _svm_probability(spark, sf, "svm_probability_rbf", MO.RbfSvm(C=1.0, gamma="scale"), 300)


@query("calibrate_isotonic")
def q_calibrate_isotonic(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    f = CL.with_folds(tr, 3)
    model, fit_s = EV.timed_fit(EN.Calibrate(MO.Logistic(C=1.0), "isotonic", folds=3), f)
    out = model.transform(te).select(KEY, F.col("label").cast("int").alias("label"), "score", "pred")
    return CL.metrics_row(spark, "calibrate_isotonic", out, fit_s)


def _smote_rows(df):
    """The training rows and their synthetic ones, as assembled features."""
    names = [f"f{i}" for i in range(len(df.first()["features"]))]
    wide = CL.as_vectors(df).select(KEY, "label", *[F.col("vec")[i].alias(n) for i, n in enumerate(names)])
    made = written(SA.smote(wide, KEY, "label", names, 5, 1.0), "resampled")  # neighbours are searched once, not in every pass
    return read_dealt(FE.assemble(made, names).select(KEY, "label", "features"))


@query("mlp")
def q_mlp(spark, sf):
    """The network, trained on the SMOTE set."""
    tr, te, _ = _prepared(spark, sf)
    d = len(tr.first()["features"])
    return CL.evaluate_estimator(spark, "mlp", SA.ResampleThenFit(_smote_rows, MO.Mlp(d, (64, 32), 200)), tr, te)


@query("gbt_xgb_like")
def q_gbt_xgb(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    ratio = profile.balance_ratio(tr, "label").first()[0]
    w = tr.withColumn("w", F.when(F.col("label") == 1, F.lit(float(ratio))).otherwise(1.0))
    return CL.evaluate_estimator(spark, "gbt_xgb_like", MO.Gbt(300, 5, 0.1, 0.8, 0.8, "w"), w, te)


@query("gbt_lgbm_like")
def q_gbt_lgbm(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "gbt_lgbm_like", MO.Gbt(300, 5, 0.05, 1.0, 0.8, "w"),
                                 _balanced(tr), te)


@query("knn_classify")
def q_knn_classify(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    t0 = time.perf_counter()
    pred = KN.knn_classify(CL.as_vectors(te), CL.as_vectors(tr), 5, "uniform", "euclidean",
                           qkey=KEY, rkey=KEY, vec="vec", label="label")
    out = te.select(KEY, F.col("label").cast("int").alias("label")).join(pred, KEY)
    out = out.cache()
    out.count()
    return CL.metrics_row(spark, "knn_classify", out, time.perf_counter() - t0)


SMOTE_COLUMNS = NUMERIC_COLUMNS


def _smote_input(spark, sf):
    """The joined policies, written once: sizes, cuts, minority and result read them again."""
    return written(CL.cleaned(policies(spark, sf)).select(KEY, LABEL, *SMOTE_COLUMNS), "policies")


@query("smote")
def q_smote(spark, sf):
    """The synthetic rows that bring the rare class to parity (their keys are new), and rows without a key."""
    p = _smote_input(spark, sf)
    return rounded(SA.smote(p, KEY, LABEL, SMOTE_COLUMNS, k=5, strategy=1.0, keep=F.col(KEY).isNull()))


@query("resample_in_fold")
def q_resample_in_fold(spark, sf):
    """Logistic regression with SMOTE applied to the training split only; see
    ``smote_in_folds`` for the training sets of a cross-validation."""
    tr, te, _ = _prepared(spark, sf)
    return CL.evaluate_estimator(spark, "logistic_smote", SA.ResampleThenFit(_smote_rows, MO.Logistic(C=1.0)), tr, te)


@query("smote_in_folds")
def q_smote_in_folds(spark, sf):
    """The synthetic rows of each of five training sets, from one neighbour join."""
    p = SA.stratified_kfold(_smote_input(spark, sf), KEY, LABEL, 5, 17)
    return rounded(SA.smote_in_folds(p, KEY, LABEL, SMOTE_COLUMNS, "fold", k=5))


def _smote_folds(spark, sf):
    """The training rows with folds and one column per feature, the names of these, and the
    synthetic rows of every fold's training set."""
    tr, _, _ = _prepared(spark, sf)
    names = [f"f{i}" for i in range(len(tr.first()["features"]))]
    f = CL.as_vectors(CL.with_folds(tr, 5)).select(KEY, "label", "fold", *[F.col("vec")[i].alias(n) for i, n in enumerate(names)])
    return f, names, written(SA.smote_in_folds(f, KEY, "label", names, "fold", k=5), "synthetic")


@query("grid_search_smote")
def q_grid_search_smote(spark, sf):
    """Logistic regression over C with SMOTE inside every training fold."""
    f, names, made = _smote_folds(spark, sf)
    results, _, _ = TU.grid_search(lambda C: MO.Logistic(C=C), {"C": [0.1, 0.5, 1.0]}, FE.assemble(f, names), KEY, refit_best=False,
                                   synthetic=FE.assemble(made, names).select("excluded", KEY, "label", "features"))
    return results


@query("grid_search_tree_smote")
def q_grid_search_tree_smote(spark, sf):
    """Decision trees over impurity, depth and smallest split with SMOTE inside every training fold."""
    f, names, made = _smote_folds(spark, sf)
    results, _, _ = TU.grid_search(lambda **c: MO.Tree(**c), TREE_GRID, FE.assemble(f, names), KEY, refit_best=False,
                                   synthetic=FE.assemble(made, names).select("excluded", KEY, "label", "features"))
    return results


@query("knn_grid_smote")
def q_knn_grid_smote(spark, sf):
    """16 candidates on 5 folds, each with the synthetic rows made without the fold; two joins a metric."""
    f, names, made = _smote_folds(spark, sf)
    vec = F.array(*names).alias("vec")
    return rounded(KN.knn_grid(f.select(KEY, "label", "fold", vec), *KNN_GRID, key=KEY, vec="vec", label="label",
                               synthetic=made.select("excluded", KEY, "label", vec)))


TREE_GRID = {"impurity": ["gini", "entropy"], "depth": [5, 10, 20], "min_split": [2, 10]}


@query("grid_search_tree")
def q_grid_search_tree(spark, sf):
    """Balanced decision trees over impurity, depth and smallest split, 5 folds."""
    tr, _, _ = _prepared(spark, sf)
    results, _, _ = TU.grid_search(lambda impurity, depth, min_split: SA.WeighThenFit(MO.Tree(impurity, depth, min_split, weight_col="w")), TREE_GRID,
                                   CL.with_folds(one_per_slot(tr), 5), KEY, refit_best=False)
    return results


KNN_GRID = ([3, 5, 7, 11], ["uniform", "distance"], ["euclidean", "manhattan"])


@query("knn_grid")
def q_knn_grid(spark, sf):
    """16 candidates on 5 folds of the embeddings from two neighbour joins."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec"), "label")
    folds = SA.stratified_kfold(e, "vec_id", "label", 5, 17)
    return rounded(KN.knn_grid(folds, *KNN_GRID, key="vec_id", vec="vec", label="label"))


@query("grid_search")
def q_grid_search(spark, sf):
    """Balanced logistic regression over C, 5 stratified folds, every metric per
    (params, fold)."""
    tr, _, _ = _prepared(spark, sf)
    f = CL.with_folds(tr, 5)
    grid = {"C": [0.1, 1, 5], "solver": ["lbfgs"]}  # Spark's optimiser stands for both solvers
    results, _, _ = TU.grid_search(lambda C, solver: SA.WeighThenFit(MO.Logistic(C=C, weight_col="w")), grid, f, KEY,
                                   refit_best=False)
    return results


@query("cv_results")
def q_cv_results(spark, sf):
    return TU.cv_results(q_grid_search(spark, sf))


@query("random_search")
def q_random_search(spark, sf):
    """RBF-SVM (random Fourier features) over log-uniform C and gamma on 3
    stratified folds of all training rows."""
    tr, _, _ = _prepared(spark, sf)
    f = SA.stratified_kfold(tr, KEY, "label", 3, 17)
    results, _, _ = TU.random_search(
        lambda C, gamma: MO.RbfSvm(C=C, gamma=gamma), {"C": ("loguniform", 0.1, 10.0), "gamma": ("loguniform", 1e-3, 1e-1)},
        f, KEY, n=20, seed=17, folds=3, refit_best=False, width=300)
    return results


@query("search_subset_then_refit")
def q_search_subset(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    grid = {"impurity": ["gini", "entropy"], "depth": [None, 5, 10, 20], "min_split": [2, 5, 10]}
    t0 = time.perf_counter()
    _, best, model = TU.search_subset_then_refit(
        lambda impurity, depth, min_split: MO.Tree(impurity, depth, min_split), grid, one_per_slot(tr), KEY, "label",
        0.3, 3)
    return CL.metrics_row(spark, "tree_tuned", MO.scored(model, te, KEY), time.perf_counter() - t0)


@query("voting")
def q_voting(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    b = _balanced(tr)
    est = EN.Voting([MO.Logistic(C=0.1, weight_col="w"), MO.LinearSvm(C=1.0, weight_col="w"),
                     MO.Tree("entropy", 5, 2, weight_col="w")], "hard")
    model, fit_s = EV.timed_fit(est, b)
    out = model.transform(te).select(KEY, F.col("label").cast("int").alias("label"), "score", "pred")
    return CL.metrics_row(spark, "voting_hard", out, fit_s)


@query("voting_combine")
def q_voting_combine(spark, sf):
    """The combination step on three deterministic base scores."""
    from riskframe.functions.hashing import uniform_hash
    s = scored_fixture(spark, sf).select(KEY, "label", F.col("score").alias("s0"),
                                          uniform_hash(KEY, 11).alias("s1"),
                                          uniform_hash(KEY, 13).alias("s2"))
    s = s.withColumns({f"p{i}": (F.col(f"s{i}") >= 0.5).cast("int") for i in range(3)})
    hard = EN.combine_votes(s, 3, "hard").select(KEY, "label", F.col("pred").alias("hard"))
    soft = EN.combine_votes(s, 3, "soft").select(KEY, F.col("pred").alias("soft"),
                                                  F.col("score").alias("soft_score"))
    return rounded(hard.join(soft, KEY))


@query("stacking")
def q_stacking(spark, sf):
    tr, te, _ = _prepared(spark, sf)
    f = _balanced(CL.with_folds(tr, 5))
    from pyspark.ml.classification import LogisticRegression
    meta = LogisticRegression(featuresCol="_meta", labelCol="label", weightCol="w")
    est = EN.Stacking([SA.WeighThenFit(m) for m in (MO.Logistic(C=0.1, weight_col="w"), MO.LinearSvm(C=1.0, weight_col="w"),
                                                    MO.Tree("entropy", 5, 2, weight_col="w"))], meta, folds=5)
    model, fit_s = EV.timed_fit(est, f)
    out = MO.scored(model, te, KEY)
    return CL.metrics_row(spark, "stacking_logistic", out, fit_s)


@query("knn_join")
def q_knn_join(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec"))
    out = KN.knn_join(e, e, 5, "euclidean", qkey="vec_id", rkey="vec_id", vec="vec", exclude_self=True)
    return rounded(out.select("vec_id", "rank", F.col("nn").alias("nn_id"), "dist"))


@query("knn_vote")
def q_knn_vote(spark, sf):
    """10-class vote of the 5 nearest training embeddings (hash split)."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vec"), "label")
    s = SA.train_test_split(e, "vec_id", 0.3, 17)
    test, train = s.where(F.col("split") == "test"), s.where(F.col("split") == "train")
    out = KN.knn_classify(test, train, 5, "uniform", "euclidean", qkey="vec_id", rkey="vec_id",
                          vec="vec", label="label")
    return out.select("vec_id", "pred")


@query("score_stream")
def q_score_stream(spark, sf):
    """Fit on the labelled table, then score the unlabelled table as a stream
    of parquet files (written under the session's checkpoint folder)."""
    import uuid
    from riskframe.session import ensure_checkpoint_dir
    from riskframe.sources.tables import labelled_unlabelled
    from riskframe.streaming.scoring import run_to_files, score_stream
    labelled, unlabelled = labelled_unlabelled(spark, sf)
    train = CL.cleaned(labelled)
    fmodel = CL.feature_stages().fit(train)
    lr = MO.Logistic(C=1.0).fit(CL.model_frame(fmodel.transform(train)))
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/score_stream_{uuid.uuid4().hex}"
    incoming = CL.cleaned(unlabelled).withColumn(LABEL, F.lit(0))
    incoming.write.parquet(base + "/in")
    stream = spark.readStream.schema(incoming.schema).parquet(base + "/in")
    scored_stream = score_stream([fmodel, lr], stream).select(
        KEY, vector_to_array_col("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("pred"))
    return run_to_files(scored_stream, base + "/out", base + "/ckpt")


def vector_to_array_col(name):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(name))


@query("isotonic_fit")
def q_isotonic_fit(spark, sf):
    """Calibrated value of every distinct score."""
    from riskframe.operators.isotonic import Isotonic
    scored = scored_fixture(spark, sf)
    points = scored.groupBy("score").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("n_pos"))
    return rounded(Isotonic().fit(scored).transform(points))


@query("score_stream_restart")
def q_score_stream_restart(spark, sf):
    """A stream of the policies in many files, stopped after its first batch and started
    anew, and a third time when late files have come."""
    import uuid
    from riskframe.session import ensure_checkpoint_dir
    from riskframe.streaming.scoring import run_to_files
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/score_stream_{uuid.uuid4().hex}"
    rows = policies(spark, sf).select(KEY, F.col(LABEL).alias("label"), "n_lines")
    late = F.col("n_lines") >= 5
    rows.where(~late).repartition(4).write.parquet(base + "/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(base + "/in")
    scored = stream.select(KEY, "label", fixture_score().alias("score"))
    run_to_files(scored, base + "/out", base + "/ckpt", batches=1)
    run_to_files(scored, base + "/out", base + "/ckpt")
    rows.where(late).repartition(2).write.mode("append").parquet(base + "/in")
    return rounded(run_to_files(scored, base + "/out", base + "/ckpt"))


@query("select_columns")
def q_select_columns(spark, sf):
    """Selection by a boolean mask over the columns (every other column)."""
    p = policies(spark, sf)
    return rounded(frames.select_columns(p, [i % 2 == 0 for i in range(len(p.columns))]))


@query("write_results")
def q_write_results(spark, sf):
    """A metrics table written as parquet under the session's checkpoint
    folder and read back."""
    import uuid
    from riskframe.session import ensure_checkpoint_dir
    from riskframe.sources.sinks import write_results
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/results_{uuid.uuid4().hex}"
    write_results(rounded(EV.binary_metrics(EV.at_threshold(scored_fixture(spark, sf), 0.5))), path)
    return spark.read.parquet(path)


@query("read_strict")
def q_read_strict(spark, sf):
    """The policies as CSV, every seventh with a broken line, read under a schema."""
    from riskframe.session import shared_path
    from riskframe.sources.tables import read_strict
    path = shared_path(spark, "csv")
    n = F.regexp_extract(KEY, r"(\d+)", 1).cast("long")
    p = policies(spark, sf).select(KEY, F.when(n % 7 == 0, F.lit("many")).otherwise(F.col("n_lines").cast("string")).alias("n_lines"), "segment")
    p.write.option("header", True).csv(path)
    rows, rejected = read_strict(spark, path, f"{KEY} string, n_lines int, segment string")
    good = rows.agg(F.lit("rows").alias("part"), F.count("*").alias("n"), F.sum("n_lines").alias("n_lines"))
    return good.unionByName(rejected.agg(F.lit("rejected").alias("part"), F.count("*").alias("n"),
                                         F.count_if(F.col("line").contains("many")).alias("n_lines")))


def _compared():
    return {"logistic": SA.WeighThenFit(MO.Logistic(C=0.1, weight_col="w")),
            "tree": SA.WeighThenFit(MO.Tree("entropy", 5, 2, weight_col="w")), "nb": MO.SparkGaussianNb()}


@query("oof_scores")
def q_oof_scores(spark, sf):
    """Rows, positives and distinct keys that each (model, fold) scored out of fold."""
    tr, _, _ = _prepared(spark, sf)
    oof = OO.out_of_fold(_compared(), CL.with_folds(tr, 3), KEY, [0, 1, 2])
    return oof.groupBy("model", "fold").agg(F.count("*").alias("n"), F.sum("label").alias("n_positive"),
                                            F.count_distinct(KEY).alias("n_keys"), F.count_if(F.col("score").isNull()).alias("n_missing"))


@query("compare_at_validated_thresholds")
def q_compare_validated(spark, sf):
    """Real models on the test rows, each at the threshold of the best F1 on its
    out-of-fold scores."""
    tr, te, _ = _prepared(spark, sf)
    oof = OO.out_of_fold(_compared(), CL.with_folds(tr, 3), KEY, [0, 1, 2])
    return rounded(OO.report(_compared(), OO.chosen_thresholds(oof), tr, te, KEY))
