"""Stupid-backoff scores of documents under a bigram model of the whole corpus.

Words are lower case, split at white space; the vocabulary is every word of the
corpus. Counts are over all documents. For a pair of neighbours (v, w) in a document::

    S(w | v) = c(v w) / c(v)        if another document has the pair too
               ALPHA * c(w) / N     else

and a document's first word scores c(w) / N. The score of a document is the sum
of the natural logarithms. (A document's own pairs are in the corpus counts, so
without "another document" nothing would ever back off.) With ``vocabulary`` only
so many of the most frequent words are told apart, and every other word is one
unknown word; words fall into classes of like frequency (``STEPS`` to a doubling),
which are taken whole.

Spark does the counting: word counts are a table partitioned by hash. The most
frequent words, at most ``NUMBERED``, have short numbers and their counts are
broadcast; any other (rare) word is known by its 63-bit hash. Each document's
distinct pairs are exploded to rows that go to the partition of the pair or, if a
word is rare, of that word, once; the counts of rare words come to the same
partitions. A pair of two rare words goes to both, and each end adds the part for
which it knows the count. No rare word is more frequent than a numbered one, so
none is a hot key. Pairs of the ``HOT`` most frequent words would be; they are at
most HOT^2, so their counts are broadcast and the documents' share of them is
summed before the shuffle. A pair with a rarer word cannot exceed the HOT-th share
of all pairs. What passes through the driver is bounded by NUMBERED and HOT^2.

Each row gives one row ``(doc_id, n_words, n_backoff, log_score, mean_log)``.
Null and empty texts have 0 words, score 0 and a null mean. Repeated rows are
separate documents. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches, texts_of
from riskframe.llm.shingles import word_hashes
from riskframe.session import written

NUMBERED = 65_535
HOT = 1024
ALPHA = 0.4
STEPS = 64
#: Sign bit of the hashes of words: numbers and pairs of numbers are not negative.
SIGN = np.int64(np.iinfo(np.int64).min)
#: Keys from here on are documents; pairs of numbers are smaller.
DOCUMENT = 1 << 32
#: What stands beside a rare word: the number of the next word, BEFORE + that of
#: the word before, or one of the others; beside a document, one of the last.
BEFORE, FIRST, COUNT = 1 << 16, 1 << 17, (1 << 17) + 1
ID, WORDS, BACKOFF = 0, 1, 2


def word_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    h, text = word_hashes(texts)
    return h.view(np.int64) | SIGN, text


class Model:
    """The numbered words by hash, word counts by number (rank from 1; 0 is the
    unknown word of a closed vocabulary) and, once known, the counts of hot pairs."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, total: int, hot: int, closed: bool):
        order = np.argsort(hashes)
        self.hashes, self.number, self.closed = hashes[order], order, closed
        # the unknown word is hot, too: number 0; words follow by rank
        self.counts = np.concatenate(([max(1, total - counts.sum())], counts)).astype(np.float64)
        self.total = float(max(1, total))
        self.size = hot
        self.hot = np.zeros((hot, hot), np.int64)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word, or its (negative) hash, and the words' texts."""
        h, text = word_ids(texts)
        others = np.zeros(len(h), np.int64) if self.closed else h
        if not len(self.hashes):
            return others, text
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.number[at] + 1, others), text

    def pairs(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Distinct (text, first, second) of numbered words with their counts;
        (text, first, second) of every pair with a rare word; and the words."""
        number, text = self.numbers(texts)
        same = text[1:] == text[:-1]
        t, v, w = text[1:][same], number[:-1][same], number[1:][same]
        rare = (v < 0) | (w < 0)
        common = ~rare
        code = np.sort((t[common] << 32) | (v[common] << 16) | w[common])
        new = np.ones(len(code), bool)
        new[1:] = code[1:] != code[:-1]
        at = np.flatnonzero(new)
        code, n = code[at], np.diff(np.append(at, len(new)))
        return code >> 32, (code >> 16) & 0xFFFF, code & 0xFFFF, n, (t[rare], v[rare], w[rare]), number, text


def rare_pairs(t: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, other, text, count) of the pairs with a rare word; pairs of two rare
    words stand under both, under the first with an even and under the second
    with an odd negative ``other``."""
    order = np.lexsort((w, v, t))
    t, v, w = t[order], v[order], w[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    at = np.flatnonzero(new)
    t, v, w, n = t[at], v[at], w[at], np.diff(np.append(at, len(new)))
    both = (v < 0) & (w < 0)
    key, other = np.where(v < 0, v, w), np.where(v < 0, w, v + BEFORE)
    other[both] &= ~np.int64(1)
    return (np.concatenate((key, w[both])), np.concatenate((other, v[both] | 1)),
            np.concatenate((t, t[both])), np.concatenate((n, n[both])))


def word_counts(source: DataFrame) -> DataFrame:
    """``(word, n)``: hash and number of occurrences of every word."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for f in frames:
            h = word_ids(f["text"].tolist())[0]
            held.append(h)
            size += len(h)
            if size > 2_000_000:
                yield tally(held)
                held, size = [], 0
        if held:
            yield tally(held)

    def tally(parts: list[np.ndarray]) -> pd.DataFrame:
        h = np.sort(np.concatenate(parts))
        at = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), h[1:] != h[:-1])))
        return pd.DataFrame({"word": h[at], "n": np.diff(np.append(at, len(h)))})

    return (source.select("text").mapInPandas(count, "word long, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: int | None = None,
          hot_words: int = HOT, numbered: int = NUMBERED) -> DataFrame:
    limit = numbered if vocabulary is None else vocabulary
    if not 0 < hot_words <= limit + 1 <= 1 << 16:
        raise ValueError("word numbers take 16 bits, and the hot words are among them")
    spark = docs.sparkSession
    bounded_batches(spark)
    source = texts_of(docs, key, text)
    counts = written(word_counts(source), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    level = F.floor(F.log2("n") * STEPS).cast("int")
    # at most 64 x STEPS rows, then at most ``limit``
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect()
    taken, least = 0, 64 * STEPS
    for r in sizes:
        taken += r["words"]
        if taken > limit:
            break
        least = r["level"]
    common = sorted(counts.where(level >= least).collect(), key=lambda r: (-r["n"], r["word"]))
    model = Model(np.array([r["word"] for r in common], np.int64),
                  np.array([r["n"] for r in common], np.int64), total, hot_words, vocabulary is not None)
    first = spark.sparkContext.broadcast(model)

    def hot_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = first.value.size
        n = np.zeros(size * size, np.int64)
        for f in frames:
            _, v, w, times, *_ = first.value.pairs(f["text"].tolist())
            hot = (v < size) & (w < size)
            np.add.at(n, v[hot] * size + w[hot], times[hot])
        found = np.flatnonzero(n)
        yield pd.DataFrame({"pair": found, "n": n[found]})

    for r in (source.select("text").mapInPandas(hot_pairs, "pair long, n long")
              .groupBy("pair").agg(F.sum("n").alias("n")).collect()):
        model.hot.flat[r["pair"]] = r["n"]
    shared = spark.sparkContext.broadcast(model)

    def explode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of pairs and of rare first words; and of each document its id,
        words and backoffs, with the parts of numbered first words and hot pairs."""
        m = shared.value
        for f in frames:
            n, row = len(f), f["row"].to_numpy()
            t, v, w, times, rare, number, text = m.pairs(f["text"].tolist())
            hot = (v < m.size) & (w < m.size)
            cold = ~hot
            code, owner, often = (v[cold] << 16) | w[cold], t[cold], times[cold]
            t, v, w, times = t[hot], v[hot], w[hot], times[hot]
            c = m.hot[v, w]
            seen = c > times
            part = np.where(seen, np.log(np.maximum(c, 1) / m.counts[v]), np.log(ALPHA * m.counts[w] / m.total))
            begin = np.flatnonzero(np.concatenate((np.ones(min(1, len(text)), bool), text[1:] != text[:-1])))
            lead, led = number[begin], text[begin]
            known = lead >= 0
            base = np.bincount(t, times * part, n) + np.bincount(led[known], np.log(m.counts[lead[known]] / m.total), n)
            key, other, of, count = rare_pairs(*rare)
            lead, led = lead[~known], led[~known]
            columns = {
                "k": (code, key, lead, np.tile(row + DOCUMENT, 3)),
                "p": (np.zeros(len(code), np.int64), other, np.full(len(lead), FIRST), np.repeat([ID, WORDS, BACKOFF], n)),
                "row": (row[owner], row[of], row[led], np.tile(row, 3)),
                "n": (often, count, np.ones(len(lead), np.int64), f["doc_id"].to_numpy(), np.bincount(text, minlength=n),
                      np.bincount(t, np.where(seen, 0, times), n).astype(np.int64)),
                "x": (np.zeros(len(code) + len(key) + len(lead)), base, np.zeros(2 * n))}
            out = pd.DataFrame({name: np.concatenate(parts) for name, parts in columns.items()})
            empty = np.zeros(len(out), bool)
            at = len(code) + len(key) + len(lead)
            empty[at:at + n] = f["no_id"].to_numpy()
            out["n"] = pd.arrays.IntegerArray(out["n"].to_numpy().astype(np.int64), empty)
            yield out

    # numbers of rows come from one pass; an id may be null
    rows = source.select(F.monotonically_increasing_id().alias("row"), "text", F.col("doc_id").isNull().alias("no_id"),
                         F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"))
    pairs = rows.mapInPandas(explode, "k long, p long, row long, n long, x double")
    if vocabulary is None:
        pairs = pairs.unionByName(counts.where(level < least).select(
            F.col("word").alias("k"), F.lit(COUNT).cast("long").alias("p"), F.lit(-1).cast("long").alias("row"), "n",
            F.lit(0.0).alias("x")))
    k, p, n, c = F.col("k"), F.col("p"), F.col("n"), F.col("c")
    # one exchange by the key: pairs and words are counted in its partitions
    held = (pairs.repartition(k).withColumn("c", F.sum("n").over(Window.partitionBy("k", "p")))
            .withColumn("ck", F.max(F.when((k < 0) & (p == COUNT), n)).over(Window.partitionBy("k")))
            .where("row >= 0"))
    seen = c > n
    # the number of the word whose count is asked for: the first's of a known
    # pair, else the second's; null if that word is rare
    number = (F.when((k >= 0) & (k < DOCUMENT), F.when(seen, F.shiftright(k, 16)).otherwise(k.bitwiseAND(0xFFFF)))
              .when((k < 0) & (p >= 0) & (p < BEFORE), F.when(~seen, p))
              .when((k < 0) & (p >= BEFORE) & (p < FIRST), F.when(seen, p - BEFORE)))
    words = spark.createDataFrame([(i, float(c)) for i, c in enumerate(model.counts)], "number long, cx double")
    joined = held.withColumn("number", number).join(F.broadcast(words), "number", "left")  # NUMBERED + 1 rows
    asked = F.coalesce("cx", F.col("ck").cast("double"))
    is_doc, odd, size = k >= DOCUMENT, p.bitwiseAND(1) == 1, F.lit(model.total)
    part = (F.when(is_doc, F.col("x"))
            .when((k < 0) & (p == FIRST), F.log(asked / size))
            .when((p < 0) & odd, F.when(seen, 0.0).otherwise(n * F.log(asked)))
            .when((p < 0) & ~seen, n * F.log(F.lit(ALPHA) / size))
            .when(seen, n * F.log(c / asked)).otherwise(n * F.log(F.lit(ALPHA) * asked / size)))
    back = (F.when(is_doc, F.when(p == BACKOFF, n).otherwise(0))
            .when(((k < 0) & (p == FIRST)) | ((p < 0) & odd) | seen, 0).otherwise(n))
    sums = joined.groupBy("row").agg(
        F.max(F.when(is_doc & (p == ID), n)).alias("doc_id"), F.max(F.when(is_doc & (p == WORDS), n)).alias("n_words"),
        F.sum(back).alias("n_backoff"), F.round(F.sum(part), 6).alias("log_score"))
    return sums.select("doc_id", "n_words", "n_backoff", "log_score",
                       F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 6)).alias("mean_log"))
