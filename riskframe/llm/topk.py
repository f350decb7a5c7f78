"""Exact top-k by inner product with no-random-access aggregation.

Candidates and queries are dealt into blocks by hash, and every query block meets
every candidate block in one group of bounded size. A group sorts its candidates
once per component. For a query, each component with a non-zero weight is a list
of candidates by falling contribution (read from the other end for a negative
weight). The lists are read in parallel, deeper and deeper; a candidate's lower
bound adds to what was read the least contribution of every list it was not yet
met in, its upper bound adds the contribution at the reading position. Reading
stops when fewer than ``ENOUGH`` x k candidates have an upper bound that reaches
the k-th best lower bound, or the lists end; outsiders cannot qualify. The scores
of the rest are then resolved, and a window merges the groups' best k per query.

Components become floor(scale * x) as 64-bit integers. Vectors that are null or
hold a null or non-finite component, and rows without an id, take no part; equal
rows count once; shorter vectors are filled with zeros. Ties go to the smaller
id; scores fit 64 bits. A query meets every row but those of its own id. Other columns take no part;
empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES, QUERIES = 1024, 1024
ENOUGH = 4
FIRST_DEPTH = 256


class Lists:
    """One block of candidates, sorted per component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        rising = np.argsort(self.vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.vectors, rising, axis=0).T.astype(float)
        self.rank = np.empty(rising.shape, np.int32)  # position in each component's list
        np.put_along_axis(self.rank, rising, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)
        self.values = self.vectors.astype(float)
        self.largest = np.abs(self.values).max(initial=0.0)

    def survivors(self, allowed: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
        """Candidates that reading the lists leaves over: all that can be among
        the best k."""
        n, lists = len(self.ids), np.flatnonzero(query)
        weight = query[lists].astype(float)
        if self.largest * np.abs(weight).sum() >= 2.0 ** 50:
            return np.flatnonzero(allowed)  # bounds in doubles would not be exact
        falling = weight > 0
        every = len(lists) == len(query)
        rank, values = (self.rank, self.values) if every else (self.rank[:, lists], self.values[:, lists])
        ends = self.sorted if every else self.sorted[lists]
        place = np.where(falling, n - 1, 0).astype(np.int32) + rank * np.where(falling, -1, 1).astype(np.int32)
        least = np.where(falling, ends[:, 0], ends[:, -1]) * weight
        depth = min(n, FIRST_DEPTH)
        while True:
            edge = np.where(falling, ends[:, n - depth], ends[:, depth - 1]) * weight
            seen = (place < depth).astype(float)
            read = (seen * values) @ weight
            low = read + (least.sum() - seen @ least)
            high = read + (edge.sum() - seen @ edge)
            kth = np.partition(low[allowed], -k)[-k]
            alive = np.flatnonzero(allowed & (high >= kth))
            if len(alive) <= ENOUGH * k or depth == n:
                return alive
            depth = min(n, depth * 2)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k but those of id ``own``."""
        allowed = self.ids != own
        alive = np.flatnonzero(allowed)
        if len(alive) > ENOUGH * k and query.any():
            alive = self.survivors(allowed, query, k)
        scores = self.vectors[alive] @ query
        best = np.lexsort((self.ids[alive], -scores))[:k]
        return self.ids[alive][best], scores[best]


def _matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, x in enumerate(rows):
        out[i, :len(x)] = x
    return out


def integer_vectors(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (df.where(F.col(key).isNotNull() & F.col(vector).isNotNull())
            .where(F.coalesce(good, F.lit(False)))
            .select(F.col(key).cast("long").alias("vec_id"),
                    F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("x"))
            .dropDuplicates())


def top_k(candidates: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0,
          key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``. ``is_query`` selects the queries, by
    the column ``vec_id``, among the rows that take part."""
    rows = integer_vectors(candidates, key, vector, scale)
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    blocks, query_blocks = max(1, -(-n // CANDIDATES)), max(1, -(-n_queries // QUERIES))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int, seed: int) -> DataFrame:
        return (df.withColumn(own, F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))))

    left = dealt(rows.where(is_query), "query_block", query_blocks, "block", blocks, 1)
    right = dealt(rows, "block", blocks, "query_block", query_blocks, 2)

    def join(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = [np.empty((0, 3), np.int64)]
        if len(queries) and len(block):
            width = max(max(map(len, block["x"])), max(map(len, queries["x"])))
            lists = Lists(block["vec_id"].to_numpy(), _matrix(block["x"], width))
            for q, v in zip(queries["vec_id"], _matrix(queries["x"], width)):
                ids, scores = lists.top(q, v, k)
                out.append(np.stack([np.full(len(ids), q), ids, scores], axis=1))
        return pd.DataFrame(np.concatenate(out), columns=["query_id", "vec_id", "score"])

    parts = (left.groupBy("query_block", "block").cogroup(right.groupBy("query_block", "block"))
             .applyInPandas(join, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
