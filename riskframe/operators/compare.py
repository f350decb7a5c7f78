"""Two-frame operators (C1-C5): side-by-side profiles, category drift,
result concatenation and key-aligned column stacking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.frames import to_long


def compare_profiles(a: DataFrame, b: DataFrame, on: str = "column",
                     names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Full outer join of two per-column profiles; value columns get the
    frame name as suffix."""
    va = [c for c in a.columns if c != on]
    vb = [c for c in b.columns if c != on]
    left = a.select(on, *[F.col(c).alias(f"{c}_{names[0]}") for c in va])
    right = b.select(on, *[F.col(c).alias(f"{c}_{names[1]}") for c in vb])
    return left.join(right, on, "full_outer")


def category_diff(a: DataFrame, b: DataFrame, cols: list[str],
                  names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Values present in only one frame, per column; null counts as a value
    (set difference treats nulls as equal)."""
    both = (to_long(a, cols, "string").withColumn("_in", F.lit(1))
            .union(to_long(b, cols, "string").withColumn("_in", F.lit(2))))
    sides = both.groupBy("column", "value").agg(F.min("_in").alias("_low"), F.max("_in").alias("_high"))
    return (sides.where(F.col("_low") == F.col("_high"))
            .select("column", "value", F.when(F.col("_low") == 1, names[0]).otherwise(names[1]).alias("only_in")))


def concat_results(dfs: list[DataFrame], tags: list[str] | None = None,
                   tag_col: str = "group") -> DataFrame:
    """Union by name (missing columns become null), each part tagged."""
    parts = [d.withColumn(tag_col, F.lit(t)) for d, t in zip(dfs, tags)] if tags else dfs
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def hstack_by_key(dfs: list[DataFrame], key: str, how: str = "inner") -> DataFrame:
    """Glue column groups of the same rows by the row key (never by position)."""
    return reduce(lambda x, y: x.join(y, key, how), dfs)


def attach_bounds(df: DataFrame, bounds: DataFrame, on: str) -> DataFrame:
    """Attach per-group statistics, one row per group. Whether they are small
    enough to broadcast is left to the optimiser, which knows their size."""
    return df.join(bounds, on, "left")
