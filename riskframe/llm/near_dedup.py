"""Near-duplicate classes by DartMinHash signatures and a banded join.

Signatures. Every element (a word shingle) of weight x owns a region of height x
over a rank axis. Hashed darts are thrown into the region: the height axis is
cut into slices [0,1), [1,2), [2,4), ...; in each slice darts arrive along the
rank axis as a Poisson process whose gaps are hashes of (element, slice, number),
and a dart counts if its height is below x. Each dart names one of k
coordinates by another hash; a coordinate keeps its earliest dart. Two texts
share a coordinate's dart with probability equal to their weighted Jaccard
similarity. Ranks are followed only up to (k ln k + 2k) / total weight, which
throws about k ln k + 2k darts whatever the number of elements; a text left with
an empty coordinate goes on to twice the rank.

Classes. Texts with equal shingle sets are one node (a node's 64-bit name is a
sum of element hashes). Nodes that agree on all ``rows`` coordinates of a band
share a bucket; a pair of similarity 0.8 shares none of the 20 buckets with a
probability of 3e-5. Within buckets, exact similarity decides: a node is compared
as a centre with all nodes of other components, most connected nodes first, until
no uncompared pair joins two components. Buckets over ``BLOCK`` nodes are dealt
into blocks; the bucket's ``PIVOTS`` most connected nodes visit every block. Pairs
of other components across blocks are covered afterwards: the nodes of such buckets
meet once more where they share a rare shingle (``rare_links``), so that pages with
a common template are not compared with each other all over. A class is a connected component of the
links; its id is the smallest document id in it.

Every input row gives one row ``(doc_id, class_id)``. Null and empty texts have
no shingles and form classes of their own; texts of under five words are one
shingle. A null id stays null and never names a class (a class of null ids only
has a null id). Repeated rows share a class. Columns other than key and text take
no part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches, free_name, mix, texts_of
from riskframe.llm.shingles import shingle_hashes
from riskframe.session import written

BLOCK, PIVOTS = 128, 8
#: Copies of the row of a shared element, so that a frequent one meets its nodes in many tasks.
SALTS = 16
_ONE = np.float64(2.0 ** -53)


def _unit(h: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1] from 64-bit hashes."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * _ONE


def dart_signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int,
                    k: int) -> np.ndarray:
    """``(n, k)`` signatures of n weighted sets given as parallel arrays of
    element hashes, weights (> 0) and the number of the set. Sets without
    elements keep zeros."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(owner, weights, minlength=n)
    todo = np.flatnonzero(total > 0)
    reach = np.zeros(n)
    reach[todo] = (k * np.log(k) + 2 * k) / total[todo]
    while len(todo):
        chosen = np.isin(owner, todo)
        e, w, s = elements[chosen], weights[chosen], owner[chosen]
        keys, ranks, darts = [], [], []
        low, width, level = 0.0, 1.0, 0
        while len(e):
            seed = mix(e + np.uint64((0xA24BAED4963EE407 * (level + 1)) & (2**64 - 1)))
            at, hw, own, number = np.zeros(len(e)), w, s, 0
            while len(seed):
                dart = mix(seed + np.uint64((0x9FB21C651E98DF25 * (number + 1)) & (2**64 - 1)))
                at = at - np.log(_unit(dart)) / width
                near = at < reach[own]
                seed, at, hw, own, dart = seed[near], at[near], hw[near], own[near], dart[near]
                place = mix(dart ^ np.uint64(0xD6E8FEB86659FD93))
                hit = slice(None)
                if level or (hw < 1.0).any():
                    hit = low + width * _unit(mix(place + np.uint64(1))) <= hw
                keys.append((own * k + (place % np.uint64(k)).astype(np.int64))[hit])
                ranks.append(at[hit])
                darts.append(dart[hit])
                number += 1
            low, width, level = low + width, width if level == 0 else width * 2, level + 1
            higher = w > low
            e, w, s = e[higher], w[higher], s[higher]
        key, rank, dart = map(np.concatenate, (keys, ranks, darts))
        order = np.argsort(-rank, kind="stable")
        flat = np.zeros(n * k, np.uint64)
        hit = np.zeros(n * k, bool)
        flat[key[order]] = dart[order]  # the earliest is written last
        hit[key] = True
        filled = hit.reshape(n, k)[todo].all(axis=1)
        out[todo[filled]] = flat.reshape(n, k)[todo[filled]]
        todo = todo[~filled]
        reach[todo] *= 2
    return out


def weighted_sets(texts: list[str], words: int, counted: bool) -> tuple[np.ndarray, ...]:
    """Distinct shingles, their weights (1, or the count) and the text number."""
    h, owner = shingle_hashes(texts, words)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    count = np.diff(np.append(at, len(h))) if counted else np.ones(len(at), np.int64)
    return h[at], count.astype(np.float64), owner[at]


def as_plain_sets(e: np.ndarray, w: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A multiset as a set of (element, occurrence) hashes: plain Jaccard
    similarity of these is the weighted similarity of the counts."""
    times = w.astype(np.int64)
    if (times == 1).all():
        return e, owner
    start = np.cumsum(times) - times
    number = np.arange(times.sum()) - np.repeat(start, times)
    return mix(np.repeat(e, times) + number.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), np.repeat(owner, times)


def links(names: np.ndarray, sets: list[np.ndarray], order: np.ndarray, threshold: float,
          group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that connect everything which exact similarity connects, skipping
    pairs already joined. ``order``: the sequence in which nodes become centres.
    ``group``: components known beforehand."""
    n = len(sets)
    component = np.arange(n) if group is None else np.unique(group, return_inverse=True)[1].copy()
    size = np.array([len(x) for x in sets])
    flat, ends = np.concatenate(sets), np.cumsum(size)
    owner = np.repeat(np.arange(n), size)
    waiting = np.ones(n, bool)
    edges = []
    for c in order:
        waiting[c] = False
        other = waiting & (component != component[c])
        other &= np.minimum(size, size[c]) >= threshold * np.maximum(size, size[c]) - 1e-9
        if not other.any():
            continue
        mine = sets[c]
        if other.sum() * 4 < n:
            picks = np.flatnonzero(other)
            shared = np.array([np.isin(sets[i], mine, assume_unique=True).sum() for i in picks])
        else:
            picks = np.flatnonzero(other)
            at = np.searchsorted(mine, flat)
            at[at == len(mine)] = 0
            shared = np.bincount(owner, mine[at] == flat, minlength=n)[picks]
        union = size[picks] + size[c] - shared
        for i in picks[shared >= threshold * union - 1e-9]:
            if component[i] != component[c]:
                component[component == component[i]] = component[c]
                edges.append((int(names[c]), int(names[i])))
    return edges


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges (a, b)`` by alternating large
    and small stars; root is the smallest node of the component. Every round is
    written to the shared folder."""
    def directed(df: DataFrame) -> DataFrame:  # a > b, once
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    now = written(directed(edges), "edges")
    mark = state(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(low, "a").where("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")))
        now = written(directed(large), "edges")
        low = now.groupBy("a").agg(F.min("b").alias("m"))
        small = (now.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))))
        now = written(directed(small), "edges")
        before, mark = mark, state(now)
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def rare_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: links that, with the known components, connect everything among
    ``nodes (node, root, elements)`` that exact similarity connects.

    A node's shared elements are put in order of frequency, rarest first. Two similar
    sets have a common element among the first ``size - threshold * size + 1`` of the
    larger (its probes) and the first ``size - 2 threshold / (1 + threshold) * size + 1``
    of the smaller (its index). So nodes meet in the cells of these elements only; what
    a template gives to all its pages comes last, in a cell that few of them index."""
    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            held = [np.frombuffer(x, np.int64) for x in f["elements"]]
            size = np.array([len(x) for x in held], np.int64)
            yield pd.DataFrame({"element": np.concatenate(held) if held else np.zeros(0, np.int64),
                                "node": np.repeat(f["node"].to_numpy(), size),
                                "root": np.repeat(f["root"].to_numpy(), size), "size": np.repeat(size, size)})

    rows = nodes.mapInPandas(explode, "element long, node long, root long, size long")
    shared = (rows.groupBy("element").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
              .where("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    own = Window.partitionBy("node")
    size = F.col("size")
    ranked = (rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(shared, ["element", "salt"])
              # elements of one node alone come first in the order
              .withColumn("place", size - F.count("*").over(own) + F.row_number().over(own.orderBy("n", "element")))
              .where((F.col("place") <= size - F.ceil(threshold * size - 1e-9) + 1) & (F.col("lo") != F.col("hi")))
              .withColumn("index", F.col("place") <= size - F.ceil(2 * threshold / (1 + threshold) * size - 1e-9) + 1))
    places = written(ranked.select("element", "node", "root", "index"), "places")
    # of cells with the same nodes and the same index, one
    mark = F.struct("node", "index")
    cells = (places.groupBy("element").agg(
        F.count("*").alias("m"), F.bit_xor(F.xxhash64(mark)).alias("x"), F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("y"),
        F.max("index").alias("any"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("any and lo <> hi")
        .groupBy("m", "x", "y").agg(F.min("element").alias("element")))
    placed = (places.join(cells.select("element", F.ceil(F.col("m") / F.lit(BLOCK)).cast("int").alias("blocks")), "element")
              .join(nodes.select("node", "elements"), "node")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    visits = (placed.where("index and blocks > 1").withColumn("home", F.col("block"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block <> home").drop("home"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        # index nodes are the centres
        parts = [np.frombuffer(x, np.uint64) for x in frame["elements"]]
        order = np.flatnonzero(frame["index"].to_numpy())
        found = links(frame["node"].to_numpy(), parts, order, threshold, frame["root"].to_numpy())
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (placed.unionByName(visits).select("element", "block", "node", "root", "index", "elements")
            .groupBy("element", "block").applyInPandas(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, words: int = 5, bands: int = 20,
                    rows: int = 4, counted: bool = False, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(doc_id, class_id)`` of every row. ``counted``: weigh a shingle by its
    number of occurrences in the text, else by 1."""
    spark = docs.sparkSession
    bounded_batches(spark)
    k = bands * rows
    source = texts_of(docs, key, text).withColumn("text_hash", F.xxhash64("text"))

    def prints(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        salt = mix(np.arange(1, rows + 1, dtype=np.uint64))
        number = mix(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32))
        for f in frames:
            n = len(f)
            e, w, owner = weighted_sets(f["text"].tolist(), words, counted)
            signature = dart_signatures(e, w, owner, n, k).reshape(n, bands, rows)
            keys = mix((signature * (salt | np.uint64(1))).sum(axis=2, dtype=np.uint64) + number)
            plain, of = as_plain_sets(e, w, owner)
            name = np.zeros(n, np.uint64)
            np.add.at(name, of, mix(plain ^ np.uint64(0xE7037ED1A0B428DB)))
            some = np.bincount(owner, minlength=n) > 0
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "text_hash": f["text_hash"],
                                "node": pd.arrays.IntegerArray(mix(name).view(np.int64), ~some),
                                "bands": list(keys.view(np.int64))})

    seen = written(source.mapInPandas(prints, "doc_id long, text_hash long, node long, bands array<long>"), "prints")
    nodes = (seen.where("node is not null").groupBy("node")
             .agg(F.min(F.struct("doc_id", "text_hash")).alias("at"), F.first("bands").alias("bands")))
    spread = written(nodes.select("node", "at", F.explode("bands").alias("bucket")), "bands")
    # buckets of two nodes and more; of those with the same nodes, one
    buckets = (spread.groupBy("bucket").agg(F.count("*").alias("m"), F.bit_xor("node").alias("x"),
                                            F.bit_xor(F.xxhash64("node")).alias("y")).where("m > 1")
               .groupBy("m", "x", "y").agg(F.min("bucket").alias("bucket"), F.count("*").alias("times")))
    members = written(spread.join(buckets.select("bucket", "m", "times"), "bucket"), "members")
    fame = members.groupBy("node").agg(F.sum(F.col("m") * F.col("times")).alias("fame"),
                                       F.first("at").alias("at"))
    # the sets of these nodes, from their texts again
    wanted = fame.select("node", "fame", "at.doc_id", "at.text_hash")
    found = source.alias("s").join(
        wanted.alias("w"), F.expr("s.doc_id <=> w.doc_id and s.text_hash = w.text_hash")).select("node", "fame", "text")

    def shingle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            e, owner = as_plain_sets(*weighted_sets(f["text"].tolist(), words, counted))
            order = np.lexsort((e, owner))
            ends = np.cumsum(np.bincount(owner, minlength=len(f)))
            yield pd.DataFrame({"node": f["node"], "fame": f["fame"],
                                "elements": [x.tobytes() for x in np.split(e[order], ends[:-1])]})

    sets = written(found.mapInPandas(shingle, "node long, fame long, elements binary")
                   .dropDuplicates(["node"]), "sets")
    blocks = F.ceil(F.col("m") / F.lit(BLOCK)).cast("int")
    placed = (members.select("bucket", "m", "node").join(sets, "node")
              .withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    by_fame = Window.partitionBy("bucket").orderBy(F.desc("fame"), "node")
    pivots = (placed.where("blocks > 1").withColumn("_rank", F.row_number().over(by_fame))
              .where(F.col("_rank") <= PIVOTS).drop("_rank")
              .withColumn("home", F.col("block"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .where("block <> home").drop("home"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(x, np.uint64) for x in frame["elements"]]
        order = np.lexsort((frame["node"], -frame["fame"]))
        found = links(frame["node"].to_numpy(), parts, order, threshold)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    edges = written(placed.unionByName(pivots).select("bucket", "block", "node", "fame", "elements")
                    .groupBy("bucket", "block").applyInPandas(compare, "a long, b long"), "links")
    roots = written(connected(edges), "roots")

    # buckets of several blocks that hold several components
    wide = (members.where(F.col("m") > BLOCK).select("bucket", "node").join(roots, "node", "left")
            .withColumn("root", F.coalesce("root", "node")))
    mixed = wide.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    open_ = written(wide.join(mixed, "bucket", "left_semi").select("node", "root").distinct()
                    .join(sets.select("node", "elements"), "node"), "open")
    if not open_.isEmpty():
        more = written(rare_links(open_, threshold), "links")
        if not more.isEmpty():
            stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = written(connected(stars.unionByName(more)), "roots")

    rooted = (seen.select("doc_id", "node").join(roots, "node", "left")
              .select("doc_id", F.coalesce("root", "node").alias("root")))
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return (rooted.join(least, "root", "left")
            .select("doc_id", F.when(F.col("root").isNull(), F.col("doc_id"))
                    .otherwise(F.col("class_id")).alias("class_id")))


def one_of_each(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with all columns and one row of each near-duplicate class: the
    first by position in the table. Rows are numbered once and written, also those
    of a table: how its files are packed into partitions may change from job to job."""
    number = free_name(docs, "__row")
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    kept = (near_duplicates(rows, key=number, text=text, **options)
            .where("doc_id = class_id").select(F.col("class_id").alias(number)))
    return rows.join(kept, number, "left_semi").drop(number)
