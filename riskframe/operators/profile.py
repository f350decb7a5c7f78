"""Profiling operators.

Pattern: unpivot the columns to ``(column, value)`` and aggregate once with
``groupBy(column)``; hash aggregation combines map-side, so a column or value
holding a third of the rows costs no more than any other. Quantiles come from
``exact_quantiles`` (rank selection, no column gathered into a task). Per-column
results are tiny (one row per column), so broadcasting them back is bounded.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators.frames import dtype_columns, to_long

FENCE_K = 1.5  # fixed value: Tukey fence multiplier


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null")


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows equal to an earlier row = sum over distinct rows of (copies - 1).
    Nulls compare equal, as in pandas."""
    cols = cols or df.columns
    return (df.groupBy(*cols).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint")
                 .alias("n_duplicates")))


def unique_counts(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column."""
    cols = cols or df.columns
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return wide.unpivot([], cols, "column", "n_unique")
    # a column of nulls stays, with 0
    return to_long(df, cols, "string").distinct().groupBy("column").agg(F.count("value").alias("n_unique"))


def _corrected_moments(n, skew_pop, kurt_pop):
    """Population skewness/excess kurtosis -> bias-corrected (sample) forms."""
    n = n.cast("double")
    g1 = F.when(n >= 3, skew_pop * F.sqrt(n * (n - 1)) / (n - 2))
    g2 = F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * kurt_pop + 6))
    return g1, g2


def _moment_aggs():
    v = F.col("value")
    return [F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.var_samp(v).alias("var"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.skewness(v).alias("_skew"), F.kurtosis(v).alias("_kurt")]


def quantile_frame(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """(column, q_<p>...) from exact rank selection; one row per column."""
    spark = df.sparkSession
    res = exact_quantiles(to_long(df, cols), probs)
    names = [f"q{int(round(p * 100)):02d}" for p in probs]
    rows = [(c, *[float(res[c][p]) if c in res else None for p in probs]) for c in cols]
    schema = "column string, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, schema)


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or dtype_columns(df, "number")
    long = to_long(df, cols)
    m = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = quantile_frame(df, cols, [0.25, 0.5, 0.75])
    return m.join(F.broadcast(q), "column").select(
        "column", "count", "mean", "std", "min", F.col("q25").alias("p25"),
        F.col("q50").alias("p50"), F.col("q75").alias("p75"), "max")


def mode_frame(long: DataFrame) -> DataFrame:
    """Most frequent value per column, the smallest one on ties."""
    counted = long.where(F.col("value").isNotNull()).groupBy("column", "value").count()
    return counted.groupBy("column").agg(
        F.max_by("value", F.struct(F.col("count"), -F.col("value"))).alias("mode"))


def fences(df: DataFrame, cols: list[str], k: float = FENCE_K) -> DataFrame:
    """(column, q1, median, q3, iqr, lower, upper) from exact quartiles."""
    q = quantile_frame(df, cols, [0.25, 0.5, 0.75])
    iqr = F.col("q75") - F.col("q25")
    return q.select("column", F.col("q25").alias("q1"), F.col("q50").alias("median"),
                    F.col("q75").alias("q3"), iqr.alias("iqr"),
                    (F.col("q25") - k * iqr).alias("lower"),
                    (F.col("q75") + k * iqr).alias("upper"))


def numeric_profile(df: DataFrame, cols: list[str] | None = None, k: float = FENCE_K) -> DataFrame:
    """Fifteen statistics and the Tukey outlier count per numeric column.
    Std/var are sample (n-1); skewness/kurtosis bias-corrected; quartiles by
    linear interpolation; fences strict (x < lower or x > upper)."""
    cols = cols or dtype_columns(df, "number")
    long = to_long(df, cols)
    m = long.groupBy("column").agg(*_moment_aggs())
    skew, kurt = _corrected_moments(F.col("n"), F.col("_skew"), F.col("_kurt"))
    f = fences(df, cols, k)
    # second pass: fences are one row per column, broadcast is bounded
    outl = (long.join(F.broadcast(f.select("column", "lower", "upper")), "column")
            .groupBy("column").agg(F.count_if((F.col("value") < F.col("lower"))
                                              | (F.col("value") > F.col("upper")))
                                    .alias("outlier_count")))
    return (m.join(mode_frame(long), "column", "left").join(F.broadcast(f), "column")
            .join(outl, "column")
            .select("column", "n", "mean", F.col("median"), "mode", "std", "var", "min", "max",
                    (F.col("max") - F.col("min")).alias("range"), "q1", "q3", "iqr",
                    skew.alias("skewness"), kurt.alias("kurtosis"),
                    F.col("lower").alias("lower_bound"), F.col("upper").alias("upper_bound"),
                    "outlier_count"))


def value_counts(df: DataFrame, col: str, normalize: bool = False,
                 top: int | None = None) -> DataFrame:
    """Counts (and share) per non-null value, most frequent first. The total
    is one fitted scalar, so the share needs no join."""
    counted = df.where(F.col(col).isNotNull()).groupBy(col).count()
    out = counted
    if normalize:
        total = df.agg(F.count(col)).first()[0]
        out = out.withColumn("share", F.try_divide(F.col("count").cast("double"),
                                                   F.lit(float(total))))
    out = out.orderBy(F.col("count").desc(), F.col(col))
    return out.limit(top) if top else out


def top_categories(df: DataFrame, n: int = 5, cols: list[str] | None = None) -> DataFrame:
    """Top-n shares of every string column. ``row_number() <= n`` is planned
    with a partial group limit before the shuffle, so each task ships at most
    n rows per column."""
    cols = cols or dtype_columns(df, "string")
    long = to_long(df, cols, "string").where(F.col("value").isNotNull())
    counted = long.groupBy("column", "value").count()
    totals = counted.groupBy("column").agg(F.sum("count").alias("_total"))
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value"))
    top = counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return (top.join(F.broadcast(totals), "column")
            .select("column", "rank", "value", "count",
                    (F.col("count") / F.col("_total")).alias("share")))


def group_rate(df: DataFrame, label: str, cols: list[str] | None = None) -> DataFrame:
    """Mean label per category of every categorical column, ascending."""
    cols = cols or [c for c in dtype_columns(df, "string")]
    long = df.select(F.col(label).cast("double").alias("_y"),
                     *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ["_y"], cols, "column", "value").where(F.col("value").isNotNull())
    return (long.groupBy("column", "value")
            .agg(F.avg("_y").alias("rate"), F.count(F.lit(1)).alias("n"))
            .orderBy("column", "rate", "value"))


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair (pairwise-complete rows), long form,
    upper triangle, all pairs in a single aggregation."""
    cols = cols or dtype_columns(df, "number")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
                    for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', p{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")


def histogram(df: DataFrame, cols: list[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max] per column, last bin closed; empty
    bins included. A constant column spans [v - 0.5, v + 0.5]; a column
    without values keeps its bins, empty and without bounds."""
    cols = cols or dtype_columns(df, "number")
    long = to_long(df, cols)
    rng = long.groupBy("column").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    rng = rng.select("column",
                     F.when(F.col("mx") == F.col("mn"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                     F.when(F.col("mx") == F.col("mn"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = (long.where(F.col("value").isNotNull()).join(F.broadcast(rng), "column").withColumn("bin", b)
              .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count")))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return (grid.join(counts, ["column", "bin"], "left")
            .select("column", "bin", (F.col("lo") + F.col("bin") * width).alias("lower"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def kde(df: DataFrame, cols: list[str] | None = None, grid: int = 200, bins: int = 512,
        cut: float = 3.0) -> DataFrame:
    """Gaussian density per column on ``grid`` points from min - cut*bw to
    max + cut*bw, Scott bandwidth bw = std * n^(-1/5). The data enter as
    ``bins`` equal-width bin centres weighted by count (linear in n, then a
    constant bins x grid evaluation)."""
    cols = cols or dtype_columns(df, "number")
    long = to_long(df, cols).where(F.col("value").isNotNull())
    st = long.groupBy("column").agg(F.count("value").alias("n"), F.min("value").alias("mn"),
                                    F.max("value").alias("mx"),
                                    F.stddev_samp("value").alias("sd"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    width = F.when(F.col("mx") > F.col("mn"), (F.col("mx") - F.col("mn")) / bins).otherwise(F.lit(1.0))
    b = F.least(F.floor((F.col("value") - F.col("mn")) / width), F.lit(bins - 1)).cast("int")
    binned = (long.join(F.broadcast(st), "column").withColumn("bin", b)
              .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("w")))
    centres = binned.join(F.broadcast(st), "column").withColumn(
        "c", F.col("mn") + (F.col("bin") + 0.5) * width)
    lo = F.col("mn") - cut * F.col("bw")
    step = (F.col("mx") - F.col("mn") + 2 * cut * F.col("bw")) / (grid - 1)
    pts = (centres.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
           .withColumn("x", lo + F.col("g") * step))
    z = (F.col("x") - F.col("c")) / F.col("bw")
    dens = F.col("w") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))
    return (pts.where(F.col("bw") > 0).groupBy("column", "g", "x")
            .agg(F.sum(dens).alias("density")).select("column", "g", "x", "density"))


# The class tables below have one row per class: the unpartitioned window
# over them moves at most #classes rows.
def _all():
    return Window.partitionBy()


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counted = df.groupBy(label).count()
    return counted.select(label, "count",
                          (F.col("count") / F.sum("count").over(_all())).alias("share"))


def balance_ratio(df: DataFrame, label: str) -> DataFrame:
    """negatives / positives (scale_pos_weight)."""
    y = F.col(label)
    return df.agg(F.try_divide(F.count_if(y == 0).cast("double"),
                               F.count_if(y == 1).cast("double")).alias("balance_ratio"))


def class_weights_balanced(df: DataFrame, label: str) -> DataFrame:
    """weight_c = n / (k * n_c) per class."""
    counted = df.groupBy(label).count()
    return counted.select(label, (F.sum("count").over(_all())
                                  / (F.count(F.lit(1)).over(_all()) * F.col("count")))
                          .alias("weight"))


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight as a column; the weight table has one row
    per class, so the broadcast is bounded by the number of classes."""
    w = class_weights_balanced(df, label).withColumnRenamed("weight", weight_col)
    return df.join(F.broadcast(w), label, "left")


def outlier_rows(df: DataFrame, fence_frame: DataFrame) -> DataFrame:
    """Rows outside the fences (x < lower or x > upper) per column, one pass.
    The fence table has one row per column; its values become literals."""
    b = {r["column"]: (r["lower"], r["upper"]) for r in fence_frame.collect()}
    wide = df.agg(*[F.count_if((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).alias(c)
                    for c, (lo, hi) in b.items()])
    return wide.unpivot([], list(b), "column", "n_outliers")


def outlier_filter(df: DataFrame, fence_frame: DataFrame) -> DataFrame:
    """Keep rows inside every column's fences (null compares false: dropped)."""
    cond = F.lit(True)
    for r in fence_frame.collect():
        cond = cond & F.col(r["column"]).between(F.lit(r["lower"]), F.lit(r["upper"]))
    return df.where(cond)
