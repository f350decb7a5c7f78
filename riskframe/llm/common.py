"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import written

#: Texts longer than this many characters are split into words piece by piece.
SLAB_CHARS = 4_000_000
#: The characters that tokenizers' ``\s`` stands for, as the inside of a character class.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of few rows, so that a task holds few texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def texts_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text (null: empty); other columns, whatever their
    names, take no part."""
    return df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def in_order(docs: DataFrame) -> DataFrame:
    """Rows of ``texts_of`` in range partitions by id (null first). Rows of one id
    go by the start of their text, then by a hash of the whole, so that an id with
    many different texts has many tasks; the order does not change when a task is
    run again. Whole texts are no range bounds: those pass through the driver."""
    order = [F.col("doc_id"), F.substring("text", 1, 64), F.xxhash64("text")]
    return docs.repartitionByRange(*order).sortWithinPartitions(*order, "text")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class WordCache:
    """Value of each word, computed once per worker while it is remembered.

    Two generations bound the memory: when the young one is full it becomes the
    old one, and words of the old one that are met again move back. Of all caches
    of a worker only the one in use holds anything: a worker outlives its job, and
    the next job has another operator. ``compute`` maps a list of new words to
    their values."""

    in_use: WordCache | None = None

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 250_000):
        self.compute, self.limit = compute, limit
        self.young: dict = {}
        self.old: dict = {}

    def values(self, words: list[str]) -> Iterator:
        if WordCache.in_use is not self:
            if WordCache.in_use is not None:
                WordCache.in_use.young, WordCache.in_use.old = {}, {}
            WordCache.in_use = self
        new = set(words).difference(self.young)
        if new:
            old = self.old
            known = [w for w in new if w in old]
            self.young.update((w, old[w]) for w in known)
            new.difference_update(known)
            if new:
                fresh = list(new)
                self.young.update(zip(fresh, self.compute(fresh)))
        out = map(self.young.__getitem__, words)
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        return out


def pieces(pattern: re.Pattern, text: str) -> Iterator[list[str]]:
    """All matches of a pattern that covers the text, as lists of bounded size."""
    if len(text) <= SLAB_CHARS:
        yield pattern.findall(text)
        return
    part: list[str] = []
    for m in pattern.finditer(text):
        part.append(m[0])
        if len(part) == 200_000:
            yield part
            part = []
    yield part


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def zero() -> Column:
    return F.lit(0).cast("long")


def running(rows: DataFrame, key: list[str], order: list[Column], folds: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with running values along ``order`` within ``key``, the row itself
    included. ``folds``: new column -> ("sum" or "bit_xor", what). The order is cut
    into range partitions, also inside one key; each partition takes its own running
    values and starts from what the earlier ones hold."""
    def total(c: str) -> Column:
        return (F.sum if folds[c][0] == "sum" else F.bit_xor)(f"_of_{c}")

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(rows.withColumns({f"_of_{c}": what for c, (_, what) in folds.items()})
                     .repartitionByRange(parts, *key, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a key has an offset only where it goes on from an earlier partition, so
    # there is at most one offset per partition
    offsets = (ranged.groupBy(*key, "_part").agg(*[total(c).alias(f"_of_{c}") for c in folds])
               .withColumns({f"_from_{c}": total(c).over(before) for c in folds})
               .where(F.coalesce(*[f"_from_{c}" for c in folds]).isNotNull())
               .select(*key, "_part", *[f"_from_{c}" for c in folds]))
    inside = Window.partitionBy(*key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = (ranged.withColumns({f"_run_{c}": total(c).over(inside) for c in folds})
           .join(F.broadcast(offsets), [*key, "_part"], "left"))
    values = []
    for c, (kind, _) in folds.items():
        run, start = F.col(f"_run_{c}"), F.coalesce(f"_from_{c}", zero())
        values.append((run + start if kind == "sum" else run.bitwiseXOR(start)).alias(c))
    return out.select(*rows.columns, *values)
