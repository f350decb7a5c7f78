"""Isotonic regression over weighted distinct scores (K5).

Rows are first summed to one point per distinct score. Adjacent points that violate the
order are pooled within range partitions; pooling what earlier pooling left gives the
same blocks as pooling all at once, so rounds over fewer and fewer partitions end in one
that sees the remaining blocks. These have increasing means: with labels 0 and 1, N rows
make O(N^(2/3)) of them at most, and in practice a few hundred.

Between blocks the curve is linear; beyond the first and last it is flat. Up to
``KNOTS`` corners are broadcast to the rows; beyond that, a running count of corners in
score order tells each row its segment, and the two are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.prefix import prefix_sums, rank_within
from riskframe.session import written

KNOTS = 1_000_000
#: How many range partitions of one round come together in the next.
MERGE = 16
BLOCKS = "lo double, hi double, n long, y double"


def _pool(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pool the ordered blocks of a partition until their means increase."""
    lo, hi, n, y = [], [], [], []
    for f in frames:
        for block in zip(f["lo"].tolist(), f["hi"].tolist(), f["n"].tolist(), f["y"].tolist()):
            left, right, count, total = block
            while n and y[-1] * count >= total * n[-1]:
                left, count, total = lo.pop(), count + n.pop(), total + y.pop()
                hi.pop()
            lo.append(left)
            hi.append(right)
            n.append(count)
            y.append(total)
    yield pd.DataFrame({"lo": lo, "hi": hi, "n": n, "y": y}).astype({"lo": float, "hi": float, "n": "int64", "y": float})


def isotonic_blocks(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``(lo, hi, n, y, value)``: the blocks of equal fitted value, with the rows and the
    label sum of each. Rows without a score (null, NaN) or label are left out."""
    s = F.col(score).cast("double")
    rows = df.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())
    blocks = (rows.groupBy(s.alias("lo")).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("y"))
              .select("lo", F.col("lo").alias("hi"), "n", "y"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        blocks = written(blocks.repartitionByRange(parts, "lo").sortWithinPartitions("lo").mapInPandas(_pool, BLOCKS), "blocks")
        if parts == 1:
            return blocks.withColumn("value", F.col("y") / F.col("n"))
        parts = max(1, parts // MERGE)


def corners(blocks: DataFrame) -> DataFrame:
    """``(x, v)``: both ends of every block."""
    return (blocks.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("x"), F.col("value").alias("v")))


def along(df: DataFrame, knots: DataFrame, score: str, into: str, limit: int = KNOTS) -> DataFrame:
    """``df`` with ``into``, the height at ``score`` of the line through ``knots (x, v)``;
    null where the score is null or NaN."""
    few = knots.limit(limit + 1).count() <= limit
    s = F.col(score).cast("double")
    if few:
        held = np.array(sorted((r["x"], r["v"]) for r in knots.collect())).reshape(-1, 2)  # at most ``limit`` rows
        shared = df.sparkSession.sparkContext.broadcast((held[:, 0], held[:, 1]))

        @F.pandas_udf("double")
        def height(x: pd.Series) -> pd.Series:
            return pd.Series(np.interp(x.to_numpy(), *shared.value)).where(x.notna().to_numpy())

        return df.withColumn(into, height(s))
    ranked = written(rank_within(knots, [F.col("x")], rank_col="_r"), "knots")
    left = ranked.select((F.col("_r") + 1).alias("_seg"), F.col("x").alias("_x0"), F.col("v").alias("_v0"))
    right = ranked.select(F.col("_r").alias("_seg"), F.col("x").alias("_x1"), F.col("v").alias("_v1"))
    segments = left.join(right, "_seg", "full")
    both = (df.withColumns({"_at": s, "_one": F.lit(0).cast("long")})
            .unionByName(knots.select(F.col("x").alias("_at"), F.lit(1).cast("long").alias("_one")), allowMissingColumns=True))
    placed = (prefix_sums(both, [F.col("_at"), F.desc("_one")], ["_one"]).where("_one = 0")
              .withColumnRenamed("cum__one", "_seg").join(segments, "_seg", "left"))
    slope = (F.col("_v1") - F.col("_v0")) / (F.col("_x1") - F.col("_x0"))
    value = F.coalesce(F.col("_v0") + slope * (F.col("_at") - F.col("_x0")), F.col("_v0"), F.col("_v1"))
    return placed.withColumn(into, F.when(F.col("_at").isNotNull() & ~F.isnan("_at"), value)).select(*df.columns, into)


class Isotonic(Estimator):
    """An increasing curve from ``score`` to the mean label. ``fit`` needs one row at least."""

    def __init__(self, score: str = "score", label: str = "label", into: str = "calibrated", limit: int = KNOTS):
        super().__init__()
        self.score, self.label, self.into, self.limit = score, label, into, limit

    def _fit(self, df: DataFrame) -> "IsotonicModel":
        blocks = isotonic_blocks(df, self.score, self.label)
        if blocks.isEmpty():
            raise ValueError("no row with a score and a label")
        return IsotonicModel(self, blocks)


class IsotonicModel(Model):
    def __init__(self, of: Isotonic, blocks: DataFrame):
        super().__init__()
        self.of, self.blocks = of, blocks

    def _transform(self, df: DataFrame) -> DataFrame:
        return along(df, corners(self.blocks), self.of.score, self.of.into, self.of.limit)
