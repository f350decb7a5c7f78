"""Headline timings: profiling, feature preparation and the reference's model
fits, at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``. Prints one JSON line.

Fit timings time ``fit`` only (the reference's SVM figures also include
predict). Every fit trains on the same cached, assembled training split.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    from pyspark.sql import functions as F

    from riskframe.operators import evaluate as EV, knn as KN, models as MO, profile
    from riskframe.operators import sampling as SA
    from riskframe.plans import claims as CL
    from riskframe.plans.common import PROFILE_COLUMNS, STRING_COLUMNS
    from riskframe.session import get_session
    from riskframe.sources.tables import KEY, LABEL, policies

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 4)
        print(f"[bench] {name}: {times[name]}s", file=sys.stderr, flush=True)
        return out

    pol = policies(spark, sf_dir)
    timed("numeric_profile", lambda: profile.numeric_profile(pol, PROFILE_COLUMNS).collect())
    timed("group_rate", lambda: profile.group_rate(pol, LABEL, STRING_COLUMNS).collect())
    tr, te, _ = timed("prepare_features", lambda: _prepare(CL, spark, sf_dir))
    fitted = {}

    def fit(name, est, frame=tr):
        fitted[name] = timed(f"fit_{name}", lambda: est.fit(frame))

    d = len(tr.first()["features"])
    fit("decision_tree", MO.Tree("gini", None))
    fit("logistic", MO.Logistic(C=1.0))
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PolynomialExpansion
    fit("logistic_poly", Pipeline(stages=[
        PolynomialExpansion(degree=2, inputCol="features", outputCol="_poly"),
        MO.Logistic(C=1.0, features="_poly")]))
    fit("gaussian_nb", MO.SparkGaussianNb())
    fit("svm_linear", MO.LinearSvm(C=1.0))
    fit("svm_poly", MO.PolySvm(C=1.0, degree=3))
    fit("svm_rbf", MO.RbfSvm(C=1.0, gamma="scale"))
    scored = MO.scored(fitted["logistic"], te, KEY)
    timed("auc_logistic", lambda: EV.auc(scored).collect())
    timed("knn_classify_k5", lambda: KN.knn_classify(
        CL.as_vectors(te), CL.as_vectors(tr), 5, qkey=KEY, rkey=KEY, vec="vec",
        label="label").count())
    names = [f"f{i}" for i in range(d)]
    wide = CL.as_vectors(tr).select(KEY, "label", *[F.col("vec")[i].alias(n) for i, n in enumerate(names)])
    timed("smote", lambda: SA.smote(wide, KEY, "label", names, 5, 1.0).count())
    total = round(sum(times.values()), 4)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "rows_train": tr.count(), "rows_test": te.count()}))
    spark.stop()


def _prepare(CL, spark, sf_dir):
    tr, te, fmodel = CL.prepared(spark, sf_dir)
    tr.count(), te.count()
    return tr, te, fmodel


if __name__ == "__main__":
    main()
