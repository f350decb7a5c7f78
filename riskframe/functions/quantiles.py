"""Exact quantiles without gathering a column into one task.

Spark's exact ``percentile`` keeps a map of every distinct value of a group in
one task, which does not survive a continuous column of 10^11 rows. Here a
quantile is found by rank selection in a few distributed passes:

1. one aggregation per column: ``count``, ``min``, ``max`` and
   ``percentile_approx`` at ``q +- delta``. Its rank error is at most
   ``n / accuracy``, so the bracket ``[lo, hi]`` almost surely holds the wanted
   order statistic;
2. one global aggregation of exact counts ``#(v < lo)`` and ``#(v <= hi)`` per
   target verifies the bracket (exact comparisons with literal bounds);
3. a verified bracket holding at most ``enumerate_rows`` rows is resolved by a
   window over the (value, count) pairs inside it; a larger one is narrowed
   again by ``percentile_approx`` restricted to the bracket, and a bracket that
   failed verification is widened to the side the target lies on.

Targets are (group, rank) pairs; every per-target table is bounded by
``#groups x 2 x #probs`` rows, so broadcasting it is safe. Results follow
linear interpolation between order statistics (pandas' default,
``quantile_cont`` in SQL).
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _clip(x: float) -> float:
    return min(1.0, max(0.0, x))


def exact_quantiles(long_df: DataFrame, probs: list[float], group_col: str = "column",
                    value_col: str = "value", accuracy: int = 1000,
                    enumerate_rows: int = 100000) -> dict:
    """Return ``{group: {"n", "min", "max", q: value, ...}}`` for every group
    with at least one non-null value."""
    spark = long_df.sparkSession
    g, v = F.col(group_col), F.col(value_col)
    data = long_df.select(g.alias("_g"), v.cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    # the selection makes a few passes over the same narrow (group, value)
    # frame: keep it (memory, spilling to disk) for their duration only
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _select(spark, data, probs, accuracy, enumerate_rows)
    finally:
        data.unpersist()


def _select(spark, data: DataFrame, probs, accuracy, enumerate_rows) -> dict:
    delta = 3.0 / accuracy
    probs = sorted(set(float(p) for p in probs))
    req = sorted({_clip(x) for p in probs for x in (p - delta, p, p + delta)})
    stats = data.groupBy("_g").agg(
        F.count("_v").alias("n"), F.min("_v").alias("mn"), F.max("_v").alias("mx"),
        F.percentile_approx("_v", req, accuracy).alias("pa")).collect()

    out: dict = {}
    pending: dict = {}  # (group, rank) -> bracket state
    for row in stats:
        grp, n = row["_g"], row["n"]
        out[grp] = {"n": n, "min": row["mn"], "max": row["mx"]}
        approx = dict(zip(req, row["pa"]))
        for p in probs:
            r0 = int(math.floor((n - 1) * p))
            for r in {r0, min(r0 + 1, n - 1)}:
                pending.setdefault((grp, r), {
                    "lo": approx[_clip(p - delta)], "hi": approx[_clip(p + delta)],
                    "mn": row["mn"], "mx": row["mx"],
                    # rank width a verified bracket can span (approximation error)
                    "size": n * (2 * delta + 2.0 / accuracy) + 2})
    values: dict = {}
    while pending:  # every round resolves a target or shrinks its bracket
        small = {k: t for k, t in pending.items() if t["size"] <= enumerate_rows}
        large = {k: t for k, t in pending.items() if t["size"] > enumerate_rows}
        if small:
            for key, (side, val, below, m) in _resolve(spark, data, small).items():
                t = pending[key]
                if side == 1:
                    values[key] = val
                    del pending[key]
                else:  # bracket missed the rank: widen towards it, narrow next
                    if side == 0:
                        t["lo"], t["hi"] = t["mn"], t["lo"]
                    else:
                        t["lo"], t["hi"] = t["hi"], t["mx"]
                    t["size"] = float("inf")
        if large:
            _narrow(spark, data, large, accuracy, delta)

    for grp, info in out.items():
        n = info["n"]
        for p in probs:
            pos = (n - 1) * p
            r0 = int(math.floor(pos))
            r1 = min(r0 + 1, n - 1)
            lo, hi = values[(grp, r0)], values[(grp, r1)]
            info[p] = lo + (hi - lo) * (pos - r0)
    return out


def _target_frame(spark, sub: dict):
    rows = [(i, grp, int(r), float(t["lo"]), float(t["hi"]))
            for i, ((grp, r), t) in enumerate(sub.items())]
    return spark.createDataFrame(rows, "tid int, _g string, r long, lo double, hi double"), list(sub)


def _tagged(data: DataFrame, tf: DataFrame) -> DataFrame:
    """Each row meets the few targets of its group (the target table is
    bounded by #groups x 2 x #probs, so it is broadcast) and is tagged
    0 below / 1 inside / 2 above the target's bracket."""
    v = F.col("_v")
    return data.join(F.broadcast(tf), "_g").withColumn(
        "side", F.when(v < F.col("lo"), 0).when(v > F.col("hi"), 2).otherwise(1))


def _resolve(spark, data: DataFrame, sub: dict) -> dict:
    """One pass: rows below/above a bracket collapse to one count each, rows
    inside collapse to (value, count); a running count over that short list
    finds the order statistic. Returns key -> (side, value, below, inside)."""
    tf, keys = _target_frame(spark, sub)
    g = (_tagged(data, tf)
         .withColumn("val", F.when(F.col("side") == 1, F.col("_v")))
         .groupBy("tid", "r", "side", "val").count())
    w = Window.partitionBy("tid").orderBy("side", "val").rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy("tid")
    picked = (g.withColumn("cum", F.sum("count").over(w))
              .withColumn("below", F.sum(F.when(F.col("side") == 0, F.col("count")).otherwise(0)).over(w_all))
              .withColumn("inside", F.sum(F.when(F.col("side") == 1, F.col("count")).otherwise(0)).over(w_all))
              .where(F.col("cum") > F.col("r"))
              .groupBy("tid")
              .agg(F.min_by(F.struct("side", "val", "below", "inside"),
                            F.struct("side", "val")).alias("hit"))
              .collect())
    return {keys[row["tid"]]: tuple(row["hit"]) for row in picked}


def _narrow(spark, data: DataFrame, sub: dict, accuracy: int, delta: float,
            grid: int = 200) -> None:
    """Shrink oversized brackets in one aggregation: exact counts below and
    inside each bracket plus a ``percentile_approx`` grid over the inside rows
    (the function needs literal probabilities, hence the fixed grid)."""
    tf, keys = _target_frame(spark, sub)
    probs = [i / grid for i in range(grid + 1)]
    res = (_tagged(data, tf).groupBy("tid").agg(
        F.count_if(F.col("side") == 0).alias("below"),
        F.count_if(F.col("side") == 1).alias("inside"),
        F.percentile_approx(F.when(F.col("side") == 1, F.col("_v")), probs, accuracy).alias("pa"))
        .collect())
    for row in res:
        key = keys[row["tid"]]
        t, r = sub[key], key[1]
        below, inside = row["below"], row["inside"]
        if r < below:
            t["lo"], t["hi"], t["size"] = t["mn"], t["lo"], float("inf")
        elif r >= below + inside:
            t["lo"], t["hi"], t["size"] = t["hi"], t["mx"], float("inf")
        else:
            rel = (r - below + 0.5) / inside
            slack = grid * delta + 1
            lo_i = max(0, int(math.floor(rel * grid - slack)))
            hi_i = min(grid, int(math.ceil(rel * grid + slack)))
            t["lo"], t["hi"] = row["pa"][lo_i], row["pa"][hi_i]
            t["size"] = inside * (hi_i - lo_i + 2.0) / grid + inside * 2.0 / accuracy + 2
            if t["lo"] == t["hi"]:
                t["size"] = 1  # one distinct value: resolving costs one row per side
