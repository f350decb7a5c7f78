"""A scored stream that is stopped and started again."""

import glob

from pyspark.sql import functions as F

from riskframe.streaming.scoring import run_to_files, score_stream


class Doubled:
    def transform(self, df):
        return df.withColumn("score", F.col("x") * 2)


def start(spark, base):
    stream = spark.readStream.schema("id long, x long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    return score_stream([Doubled()], stream)


def rows(df):
    return sorted((r["id"], r["score"]) for r in df.collect())


def test_no_row_is_lost_or_doubled(spark, tmp_path):
    base = str(tmp_path)
    spark.range(60).select("id", F.col("id").alias("x")).repartition(5).write.parquet(f"{base}/in")
    run_to_files(start(spark, base), f"{base}/out", f"{base}/ckpt", batches=2)
    # what a lost attempt left behind is not in the sink's log
    spark.range(5).select("id", F.col("id").alias("x"), F.col("id").alias("score")).write.parquet(f"{base}/left")
    left = glob.glob(f"{base}/left/*.parquet")[0]
    (tmp_path / "out" / "part-99999-left.snappy.parquet").write_bytes(open(left, "rb").read())
    assert rows(run_to_files(start(spark, base), f"{base}/out", f"{base}/ckpt")) == [(i, 2 * i) for i in range(60)]
    # nothing new: nothing changes; then late files
    assert run_to_files(start(spark, base), f"{base}/out", f"{base}/ckpt").count() == 60
    spark.range(60, 75).select("id", F.col("id").alias("x")).repartition(2).write.mode("append").parquet(f"{base}/in")
    assert rows(run_to_files(start(spark, base), f"{base}/out", f"{base}/ckpt")) == [(i, 2 * i) for i in range(75)]
