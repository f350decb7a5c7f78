"""Benchmark decontamination: BM25 with block-max WAND, then an overlap check.

Index. Every test item is a document of an inverted index. A posting's weight is
its BM25 contribution divided by the item's score for its own text, so an item
scores 1 for itself and a threshold means the same for short and long items.
Items lie in blocks of ``BLOCK`` neighbours; each list also keeps its maximum per
block and its maximum over all.

Queries. Every training text is cut into passages of ``span`` words (the longest
item, 64 at least) half a span apart, and each passage is a query; all items that
score ``threshold`` or more are wanted. As in WAND, lists whose maxima together
cannot reach the threshold need not propose items: for every passage the lists of
the most frequent terms, while their summed maxima stay below half the threshold,
only add their bound. The other lists add up their block maxima per block;
blocks whose bound stays below the threshold are skipped, in the rest all items
are scored exactly. Passages of a batch go through these steps together, as numpy
arrays.

Check. An item is split into question and answer (its last sentence, or the last
quarter of its words if there is one sentence only). The item counts if both the
question and the answer find ``overlap`` of their word 3-grams in the passage,
extended on either side by the length of the item.

Items are dealt into shards of at most ``SHARD_ITEMS`` by hash, so that each
index broadcast is bounded; every shard meets every text. Null and empty texts
and items match nothing; items of the same text all match. Every row is judged
by itself, so repeated rows and null ids need no care. Other columns, whatever
their names, take no part.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from riskframe.llm.common import SLAB_CHARS, bounded_batches

SHARD_ITEMS = 20_000
BLOCK = 4
K1, B = 1.2, 0.75
NGRAM = 3
WORD = re.compile(r"\w+")
_END = re.compile(r"[.!?\n]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@F.pandas_udf(ArrayType(StringType()))
def _words(texts: pd.Series) -> pd.Series:
    return texts.map(words_of)


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Question words and answer words."""
    parts = [w for w in (words_of(p) for p in _END.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def grams(words: list) -> set[tuple]:
    n = min(NGRAM, len(words))
    return set(zip(*[words[i:] for i in range(n)])) if n else set()


def postings(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, text, len, shard, terms)``: ``len`` words, ``terms`` holds (term,
    weight) pairs."""
    base = (items.select(F.col(key).alias("item_id"), F.col(text).alias("text"))
            .where("text is not null").dropDuplicates()
            .withColumn("words", _words("text"))  # the words of passages are cut by the same rule
            .where("size(words) > 0"))
    n, mean = base.agg(F.count("*"), F.avg(F.size("words"))).first()
    if not n:
        return base.select("item_id", "text", F.size("words").alias("len"), F.lit(0).alias("shard"),
                           F.array().cast("array<struct<term:string,w:double>>").alias("terms"))
    terms = (base.select("item_id", "text", F.size("words").alias("len"), F.explode("words").alias("term"))
             .groupBy("item_id", "text", "len", "term").agg(F.count("*").alias("tf")))
    # one row per term of the benchmark and number of items that have it
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.lit(mean)))
    shards = max(1, math.ceil(n / SHARD_ITEMS * 1.1) if n > SHARD_ITEMS else 1)
    return (terms.join(df, "term").withColumn("w", part)
            .groupBy("item_id", "text", "len").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
            .withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int")))


class Index:
    """One shard: lists in compressed rows, block maxima and the items' parts."""

    def __init__(self, rows: list, threshold: float, overlap: float, span: int):
        rows = sorted(rows, key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["text"]))
        self.threshold, self.overlap, self.span = threshold, overlap, span
        self.items = [r["item_id"] for r in rows]
        split = [split_item(r["text"]) for r in rows]
        self.parts = [(grams(q), grams(a)) for q, a in split]
        self.sizes = [len(q) + len(a) for q, a in split]
        self.terms: dict[str, int] = {}
        entries = []
        for i, r in enumerate(rows):
            total = sum(t["w"] for t in r["terms"])
            for t in r["terms"]:
                number = self.terms.setdefault(t["term"], len(self.terms))
                entries.append((number, i, t["w"] / total if total else 0.0))
        table = np.array(sorted(entries)).reshape(-1, 3)
        term, self.item, self.weight = table[:, 0].astype(np.int64), table[:, 1].astype(np.int64), table[:, 2]
        n = len(self.terms)
        self.start = np.searchsorted(term, np.arange(n + 1))
        # block maxima of every list
        blocks = self.item // BLOCK
        first = np.ones(len(term), bool)
        first[1:] = (term[1:] != term[:-1]) | (blocks[1:] != blocks[:-1])
        at = np.flatnonzero(first)
        self.block, self.block_max = blocks[at], np.maximum.reduceat(self.weight, at) if len(at) else self.weight
        self.block_start = np.searchsorted(term[at], np.arange(n + 1))
        self.top = np.maximum.reduceat(self.weight, self.start[:-1]) if n else np.zeros(0)
        self.count = np.diff(self.start)
    def numbers(self, words: list[str]) -> np.ndarray:
        """Term number of each word, -1 where no item has it."""
        return np.fromiter(map(self.terms.get, words, repeat(-1)), np.int32, len(words))

    def search(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (passage, item, score) at or over the threshold, for distinct
        (passage, term) pairs that are sorted by passage."""
        if not len(passage):
            return passage, passage, np.zeros(0)
        limit = self.threshold - 1e-9
        n = int(passage[-1]) + 1
        bound = np.bincount(passage, self.top[term], n)
        alive = bound[passage] >= limit
        passage, term = passage[alive], term[alive]
        if not len(passage):
            return passage, passage, np.zeros(0)
        # frequent terms first; while their maxima stay under half the threshold
        # they only add to the bound
        order = np.lexsort((-self.count[term], passage))
        passage, term = passage[order], term[order]
        total = np.cumsum(self.top[term])
        opened = np.searchsorted(passage, np.arange(n))
        before = np.concatenate(([0.0], total))[opened]
        run = total - before[passage]
        essential = run >= limit / 2
        rest = np.bincount(passage, np.where(essential, 0.0, self.top[term]), n)
        # block bounds from the essential lists
        p, t = passage[essential], term[essential]
        which, at = _spread(self.block_start, t)
        blocks = int(self.block.max()) + 1
        cell = p[which] * blocks + self.block[at]
        cells, bounds = _sums(cell, self.block_max[at])
        keep = bounds + rest[cells // blocks] >= limit
        cells = cells[keep]
        if not len(cells):
            return cells, cells, np.zeros(0)
        # exact scores in the opened blocks, with all lists
        wanted = np.unique(cells // blocks)
        some = np.isin(passage, wanted)
        p, t = passage[some], term[some]
        which, at = _spread(self.start, t)
        owner, item = p[which], self.item[at]
        inside = np.isin(owner * blocks + item // BLOCK, cells)
        pair = owner[inside] * len(self.items) + item[inside]
        pairs, scores = _sums(pair, self.weight[at][inside])
        good = scores >= limit
        pairs = pairs[good]
        return pairs // len(self.items), pairs % len(self.items), scores[good]

    def match(self, texts: list[str | None]) -> list[list[tuple]]:
        """Per text, ``(item_id, score, question, answer)`` of the items that it
        contains."""
        out: list[list[tuple]] = [[] for _ in texts]
        half = self.span // 2
        numbers = []
        for t in texts:
            ids = [self.numbers(words_of(t))] if t and len(t) <= SLAB_CHARS else \
                [self.numbers(part) for part in _slabs(t)] if t else []
            numbers.append(np.concatenate(ids) if ids else np.zeros(0, "<i4"))
        # the passages of all texts, numbered through; a word lies in two of them
        steps = np.array([max(1, -(-len(x) // half)) for x in numbers])
        begin = np.cumsum(steps) - steps
        size = np.array([len(x) for x in numbers])
        flat = np.concatenate(numbers) if len(numbers) else np.zeros(0, "<i4")
        if not self.items or not len(flat):
            return out
        text = np.repeat(np.arange(len(texts)), size)
        place = (np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)) // half
        known = flat >= 0
        text, place, term = text[known], place[known], flat[known].astype(np.int64)
        own = begin[text] + place
        earlier = place > 0
        code = np.concatenate((own, own[earlier] - 1)) * len(self.terms) + np.concatenate((term, term[earlier]))
        code = np.sort(code)
        code = code[np.concatenate(([True], code[1:] != code[:-1]))] if len(code) else code
        passage, item, score = self.search(code // len(self.terms), code % len(self.terms))
        best: dict[tuple[int, int], tuple] = {}
        held, words = -1, []  # the words of the text at hand; passages come in order
        for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist()):
            d = int(np.searchsorted(begin, p, "right")) - 1
            at = (p - begin[d]) * half
            low, high = max(0, at - self.sizes[i]), at + self.span + self.sizes[i]
            if d != held:
                held, words = d, words_of(texts[d])
            q, a = self._overlaps(words[low:high], i)
            if q >= self.overlap and a >= self.overlap:
                found = (self.items[i], round(s, 6), q, a)
                if (d, i) not in best or found[1:] > best[d, i][1:]:
                    best[d, i] = found
        for (d, _), found in sorted(best.items()):
            out[d].append(found)
        return out

    def _overlaps(self, words: list[str], i: int) -> tuple[float, float]:
        near = {n: set(zip(*[words[j:] for j in range(n)])) for n in range(1, NGRAM + 1)}

        def share(part: set[tuple]) -> float:
            # an item without a question (or answer) of its own asks nothing of it
            return len(part & near[len(next(iter(part)))]) / len(part) if part else 1.0

        q, a = self.parts[i]
        return share(q), share(a)


def _slabs(text: str) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for m in WORD.finditer(text.lower()):
        out[-1].append(m[0])
        if len(out[-1]) == 200_000:
            out.append([])
    return out


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's values."""
    if not len(keys):
        return keys, np.zeros(0)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(values[order], at)


def _spread(start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of compressed rows: (position in ``rows``, entry) of each."""
    n = start[rows + 1] - start[rows]
    which = np.repeat(np.arange(len(rows)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[rows][which]
    return which, at


MATCHES = "array<struct<item_id:long,score:double,question:double,answer:double>>"


def _search(shared):
    @F.pandas_udf(MATCHES)
    def search(texts: pd.Series) -> pd.Series:
        rows = shared.value.match(texts.tolist())
        return pd.Series([[dict(zip(("item_id", "score", "question", "answer"), x)) for x in r] for r in rows],
                         dtype=object)
    return search


def matches(docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.5,
            text: str = "text", item_key: str = "item_id", item_text: str = "text",
            into: str = "leaks") -> DataFrame:
    """``docs`` with a column ``into``: the items that each text contains, as an
    array of (item_id, score, question, answer)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    index = postings(items, item_key, item_text).cache()
    longest = index.agg(F.max("len")).first()[0] or 0
    span = max(64, longest + longest % 2)
    shards = sorted(r["shard"] for r in index.select("shard").distinct().collect())
    found = []
    for s in shards:
        # bounded by SHARD_ITEMS
        one = Index(index.where(F.col("shard") == s).collect(), threshold, overlap, span)
        found.append(_search(spark.sparkContext.broadcast(one))(F.col(text).cast("string")))
    index.unpersist()
    leaks = F.concat(*found) if found else F.array().cast(MATCHES)
    return docs.withColumn(into, leaks)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(doc_id, item_id, score, question, answer)``, one row per text and item."""
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return (matches(plain, items, **options).select("doc_id", F.explode("leaks").alias("x"))
            .select("doc_id", "x.*"))
