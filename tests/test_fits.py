import threading

from pyspark.sql import functions as F

from riskframe.operators.ensemble import Calibrate, Stacking
from riskframe.plans import claims
from riskframe.session import FEW_ROWS, MANY_ROWS, dealt, fit_parts, side_by_side


def test_fit_parts_follow_rows_and_slots():
    assert fit_parts(0, 12) == 1
    assert fit_parts(FEW_ROWS + 1, 12) == 2
    assert fit_parts(630_000, 12) == 12
    assert fit_parts(38_000_000, 12) == 156 and 38_000_000 / 156 <= MANY_ROWS


def test_dealt_rows_of_many_partitions(spark):
    rows = spark.range(500, numPartitions=97).withColumn("x", F.col("id") % 7)
    few = dealt(rows)
    assert few.rdd.getNumPartitions() == 1
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, rows.collect()))
    few.unpersist()


def test_prepared_rows_lie_in_few_partitions(spark, tmp_path):
    n = 400
    spark.range(40).select(F.col("id").alias("c_custkey"), (F.col("id") % 5).cast("int").alias("c_nationkey"), (F.col("id") * 3.5).alias("c_acctbal"),
                           F.lit("A").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey"),
                          F.when(F.col("id") % 4 == 0, "F").otherwise("O").alias("o_orderstatus"), (F.col("id") * 1.25).alias("o_totalprice"),
                          F.lit("1995-02-03").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(2 * n).select((F.col("id") % n).alias("l_orderkey"), (F.col("id") % 9).cast("double").alias("l_quantity"),
                              (F.col("id") * 2.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount")).write.parquet(f"{tmp_path}/lineitem.parquet")
    given = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tr, te, _ = claims.prepared(spark, str(tmp_path))
        assert (tr.count(), te.count()) == (280, 120)
        assert tr.rdd.getNumPartitions() == te.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", given)


class Waits:
    """Fits only while another fit runs, too."""

    def __init__(self, barrier):
        self.barrier = barrier

    def fit(self, df):
        self.barrier.wait(20)
        return self

    def transform(self, df):
        return df.withColumn("score", F.col("x").cast("double")).withColumn("pred", (F.col("x") > 3).cast("int"))


def _folds(spark):
    return spark.range(60).select("id", (F.col("id") % 7).alias("x"), (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("fold"))


def test_fits_of_calibration_and_stacking_overlap(spark):
    rows = _folds(spark)
    model = Calibrate(Waits(threading.Barrier(2)), "sigmoid", folds=3).fit(rows)
    assert model.transform(rows).where("score is null").count() == 0
    Stacking([Waits(threading.Barrier(2)), Waits(threading.Barrier(2))], folds=3).fit(rows)


def test_wide_fits_run_one_by_one(spark):
    running, most = [], []

    def fit(job):
        running.append(job)
        most.append(len(running))
        running.remove(job)
        return job * 2

    assert side_by_side(fit, [1, 2, 3], spark.range(10), width=10 ** 12) == [2, 4, 6]
    assert max(most) == 1


def test_resampled_rows_are_written_and_dealt(spark):
    from pyspark.ml.functions import array_to_vector
    from riskframe.plans.queries import _smote_rows
    x = F.array((F.col("id") % 11).cast("double"), (F.col("id") % 5).cast("double"))
    rows = spark.range(90, numPartitions=30).select(F.concat(F.lit("k"), "id").alias("policy_id"),
                                                    (F.col("id") % 9 == 0).cast("double").alias("label"), array_to_vector(x).alias("features"))
    made = _smote_rows(rows)
    assert made.groupBy("label").count().orderBy("label").collect() == [(0.0, 80), (1.0, 80)]
    assert made.rdd.getNumPartitions() == 1
    made.unpersist()


def test_resampled_rows_are_read_from_their_files(spark):
    from pyspark.ml.functions import array_to_vector
    from riskframe.plans.queries import _smote_rows
    x = F.array((F.col("id") % 11).cast("double"), (F.col("id") % 5).cast("double"))
    made = _smote_rows(spark.range(90, numPartitions=30).select(F.concat(F.lit("k"), "id").alias("policy_id"),
                                                                (F.col("id") % 9 == 0).cast("double").alias("label"), array_to_vector(x).alias("features")))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and not (made.storageLevel.useMemory or made.storageLevel.useDisk)
    assert made.count() == 160 and made.rdd.getNumPartitions() == 1


def test_poly_width_counts_the_terms_that_are_kept(spark):
    from pyspark.ml.linalg import Vectors
    from riskframe.operators.models import poly_width
    rows = spark.createDataFrame([(Vectors.sparse(22, [1, 5], [2.0, 3.0]),), (Vectors.sparse(22, [0, 9], [1.0, 1.0]),)], ["features"])
    assert poly_width(rows, 3) == 15  # 10 terms of two features up to degree 3
    assert poly_width(rows.limit(0), 3) == 1


class Partitions:
    seen: list = []

    def fit(self, df):
        Partitions.seen.append(df.rdd.getNumPartitions())
        return self

    def transform(self, df):
        return df.withColumn("score", F.lit(0.5)).withColumn("pred", F.lit(1))


def test_synthetic_rows_add_no_tasks_to_a_fit(spark):
    from riskframe.operators.tuning import grid_search
    slots = spark.sparkContext.defaultParallelism
    rows = _folds(spark).repartition(slots)
    made = rows.withColumn("excluded", F.col("fold")).drop("fold").repartition(3 * slots)
    Partitions.seen.clear()
    grid_search(lambda: Partitions(), [{}], rows, "id", folds=3, refit_best=False, synthetic=made.select("excluded", "id", "x", "label"))
    assert len(Partitions.seen) == 3 and max(Partitions.seen) <= slots
