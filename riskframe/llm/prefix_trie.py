"""Prefix trie of rebuilt conversations, by whole-sequence collapse.

Identical rebuilt conversations are grouped into one weighted sequence with the
list of its ends. A sequence that is a proper prefix of another one is dropped
by an anti-join; the others are the leaves. The prefixes of the weighted
sequences, aggregated, are the nodes of the trie. No tree is walked and no pair
of a node with its descendants is made:

* A prefix is named by its depth and 128 bits, the running exclusive-or of hashes
  of (place, role, text). Texts are hashed first and travel no further.
* A subtree's sum of ``(n_convs - 1) * chars`` is taken over the sequences that
  pass its top: each adds its weight times its characters from there on, and
  takes off once the characters of the nodes it owns. A node's owner is the least
  sequence that passes it, so what a sequence owns is a tail of its own path.

Running numbers and running hashes are taken within range partitions, plus one
offset per key and partition (``running``), so a conversation that holds a third
of all turns is spread over tasks; joins on a conversation go by stretches of its
turns. The ends of a sequence are put in order the same way and joined in runs of
``RUN`` ids by many tasks; only these strings pass, as a stream, through the one
SHA-256 that the result asks for.

Defined cases. Turns are ordered by turn (null first), ties by role, then by the
first 64 characters of the text, then by hash; repeated rows are turns of their
own. Null role or text is empty. Rows without a conversation id belong to no
conversation. A conversation whose rebuilt form has no turns ends at the root. An
empty table has no root: the result is empty. Other columns, whatever their
names, take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import running, zero
from riskframe.session import written

#: Turns of one conversation that a join may bring to one task.
STRETCH = 10_000
#: Ids that are joined into one string before they are hashed.
RUN = 10_000
NAME = ["k1", "k2", "depth"]


def turns_of(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, place, h1, h2, chars): the turns of every conversation, numbered
    from 1, each by two hashes of role and text."""
    rows = (conversations.where(F.col(key).isNotNull())
            .select(F.col(key).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                    F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .select("conv_id", "turn", "role", F.substring("text", 1, 64).alias("start"),
                    F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("again"), "text", "role").alias("h2"),
                    F.length("text").cast("long").alias("chars")))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("start"), F.col("h1"), F.col("h2")]
    return (running(rows, ["conv_id"], order, {"place": ("sum", F.lit(1).cast("long"))})
            .select("conv_id", "place", "h1", "h2", "chars"))


def stretches(length: str) -> Column:
    return F.explode(F.sequence(zero(), F.expr(f"{length} div {STRETCH}"))).alias("stretch")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length, depth, h1, h2, chars), the turns of the rebuilt
    conversations, and (conv_id, length) of all, also of those without turns."""
    heads = (turns.where("conv_id % 100 = 0 and place <= 5").groupBy(F.col("conv_id").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("place", "h1", "h2", "chars"))).alias("head")))
    none = F.array().cast("array<struct<place:bigint,h1:bigint,h2:bigint,chars:bigint>>")
    convs = written(
        turns.groupBy("conv_id").agg(F.max("place").alias("own"))
        .withColumn("base", F.expr("conv_id - conv_id % 100"))
        .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6)
        .join(heads, "base", "left")
        .withColumn("head", F.slice(F.coalesce("head", none), F.lit(1), F.col("h").cast("int")))
        .withColumn("from_base", F.size("head").cast("long"))
        .withColumn("length", F.col("from_base") + F.greatest(F.col("own") - F.col("h"), zero())), "convs")
    first = (convs.select("conv_id", "length", F.explode("head").alias("t"))
             .select("conv_id", "length", F.col("t.place").alias("depth"), "t.h1", "t.h2", "t.chars"))
    rest = (turns.withColumn("stretch", F.expr(f"place div {STRETCH}"))
            .join(convs.select("conv_id", "h", "from_base", "length", stretches("own")), ["conv_id", "stretch"])
            .where("place > h")
            .select("conv_id", "length", (F.col("place") - F.col("h") + F.col("from_base")).alias("depth"), "h1", "h2", "chars"))
    return first.unionByName(rest), convs.select("conv_id", "length")


def ends_hashes(ends: DataFrame) -> DataFrame:
    """``(k1, k2, depth, ends_sha256)`` from ``(k1, k2, depth, conv_id)``: SHA-256
    of the ids in ascending order, joined by commas."""
    runs = (running(ends, NAME, [F.col("conv_id")], {"place": ("sum", F.lit(1).cast("long"))})
            .groupBy(*NAME, F.expr(f"(place - 1) div {RUN}").alias("run"))
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for f in frames:
            done = []
            for k1, k2, depth, ids in zip(f["k1"].tolist(), f["k2"].tolist(), f["depth"].tolist(), f["ids"]):
                if (k1, k2, depth) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = (k1, k2, depth), hashlib.sha256(ids.encode())
            yield pd.DataFrame(done, columns=[*NAME, "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*NAME, "ends_sha256"])

    return (runs.repartition(*NAME).sortWithinPartitions(*NAME, "run").select(*NAME, "ids")
            .mapInPandas(hashed, "k1 long, k2 long, depth long, ends_sha256 string"))


def trie(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
         text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    turns, lengths = rebuilt(written(turns_of(conversations, key, turn, role, text), "turns"))
    steps = {"s1": F.xxhash64("depth", "h1", "h2"), "s2": F.xxhash64("h2", "depth", "h1")}
    paths = written(running(turns.withColumns(steps), ["conv_id"], [F.col("depth")],
                            {"k1": ("bit_xor", F.col("s1")), "k2": ("bit_xor", F.col("s2")), "until": ("sum", F.col("chars"))})
                    .select("conv_id", "length", *NAME, F.col("k1").bitwiseXOR(F.col("s1")).alias("p1"),
                            F.col("k2").bitwiseXOR(F.col("s2")).alias("p2"), (F.col("until") - F.col("chars")).alias("before"),
                            "until"), "paths")
    # identical conversations are one sequence, named by its least conversation
    whole = written(paths.where("depth = length").select("conv_id", *NAME, F.col("until").alias("total")).unionByName(
        lengths.where("length = 0").select("conv_id", zero().alias("k1"), zero().alias("k2"), zero().alias("depth"), zero().alias("total"))), "whole")
    sequences = written(whole.groupBy(*NAME).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"),
                                                 F.first("total").alias("total")), "sequences")
    about = sequences.select("conv_id", "weight", "total", F.col("depth").alias("length"))
    roots = about.select("*", zero().alias("k1"), zero().alias("k2"), zero().alias("depth"), F.lit(None).cast("long").alias("p1"),
                         F.lit(None).cast("long").alias("p2"), zero().alias("before"))
    prefixes = written(
        paths.drop("length", "until").withColumn("stretch", F.expr(f"depth div {STRETCH}"))
        .join(about.select("*", stretches("length")), ["conv_id", "stretch"]).select(roots.columns).unionByName(roots), "prefixes")
    # a sequence that goes on elsewhere is no leaf
    leaves = (sequences.join(prefixes.where("depth < length").select(*NAME), NAME, "left_anti")
              .select("conv_id", F.lit(1).cast("long").alias("leaf")))
    nodes = written(prefixes.groupBy(*NAME).agg(F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
                                                F.first("p1").alias("p1"), F.first("p2").alias("p2"),
                                                F.first("before").alias("before")), "nodes")
    # each sequence at each of its prefixes: its characters from there on, weighted, less those of the nodes it owns
    owned = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "before"))["before"].alias("owned_from"))
    own = about.select("conv_id", stretches("length")).join(owned, "conv_id", "left").join(leaves, "conv_id", "left")
    at = (prefixes.withColumn("stretch", F.expr(f"depth div {STRETCH}")).join(own, ["conv_id", "stretch"])
          .select(*NAME, "leaf", (F.col("weight") * (F.col("total") - F.col("before"))
                                  - F.when(F.col("owned_from").isNull(), zero())
                                  .otherwise(F.col("total") - F.greatest("owned_from", "before"))).alias("saved")))
    sums = at.groupBy(*NAME).agg(F.coalesce(F.sum("leaf"), zero()).alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    children = (nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count("*").alias("n_children")))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), (F.col("depth") + 1).alias("depth"),
                         F.col("conv_id").alias("parent_conv_id"))
    return (nodes.drop("before").join(sums, NAME).join(children, NAME, "left")
            .join(ends_hashes(whole.select(*NAME, "conv_id")), NAME, "left").join(above, ["p1", "p2", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero()).alias("n_children"),
                    "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
