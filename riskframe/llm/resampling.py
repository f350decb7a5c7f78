"""Importance resampling towards a target distribution, with a head-tail vocabulary.

Features are all runs of one to three words; a feature's bucket is its CRC-32
modulo ``BUCKETS``. A text's words are looked up in the head: the most frequent
words of the corpus, whose CRC states are broadcast. The pairs of the
``PAIR_WORDS`` most frequent of these have their CRC states, and so their buckets,
in a table. All other words and runs, the tail, take their CRC directly: a
run's state is the state of what stands before its last word, moved on by that
word's bytes. Both ways give the same number, so the head only saves time: the
totals per bucket count every feature of every text exactly.

One pass counts words for the head (none longer than ``LONG`` bytes is in it),
one writes each text's buckets, two narrow ones over these sum the totals and
the gains. The head holds at most ``HEAD`` words and the totals ``BUCKETS``
numbers: these bounds are all that is broadcast. Long texts are cut into slabs of
``SLAB`` bytes at the end of a word; two words are carried over the cut.

Ranks come from range partitions and their offsets (``running``), not from one
task. Ties of score go to the smaller id (null ids last), then to fewer features.

Defined cases. Null and empty texts have no words, no features and weight 0; with
no texts at all nothing is drawn. A null id hashes like the empty string and stays null.
Repeated rows are rows of their own. Other columns take no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches, running, texts_of
from riskframe.session import written

BUCKETS = 10_000
HEAD, PAIR_WORDS = 8_192, 512
LONG = 48
SLAB = 4_000_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")


def _byte_steps() -> np.ndarray:
    """CRC remainder of every byte (polynomial: the fixed value of CRC-32)."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & 1, (r >> 1) ^ np.uint32(0xEDB88320), r >> 1)
    return r


STEP = _byte_steps()


def _shift_tables() -> np.ndarray:
    """``[n, k, b]``: what byte b at place k of a state becomes n zero bytes later."""
    out = np.empty((LONG + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(LONG):
        out[n + 1] = STEP[out[n] & 255] ^ (out[n] >> 8)
    return out


SHIFT = _shift_tables()


def then(state: np.ndarray, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of A + B from the CRC of A, the CRC of B and the bytes of B (at most LONG)."""
    return (SHIFT[length, 0, state & 255] ^ SHIFT[length, 1, (state >> 8) & 255]
            ^ SHIFT[length, 2, (state >> 16) & 255] ^ SHIFT[length, 3, state >> 24] ^ crc)


def then_blank(state: np.ndarray) -> np.ndarray:
    s = ~state
    return ~(STEP[(s ^ np.uint32(32)) & 255] ^ (s >> 8))


def slabs(text: str) -> Iterator[list[bytes]]:
    """The words of a text, some ``SLAB`` bytes at a time."""
    raw = text.encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    at = 0
    while at < len(raw):
        cut = _BREAK.search(raw, at + SLAB) if at + SLAB < len(raw) else None
        end = cut.start() if cut else len(raw)
        yield WORD.findall(raw, at, end)
        at = end


class Head:
    """CRC states of frequent words and of pairs of the most frequent ones."""

    def __init__(self, words: list[bytes]):
        self.number = {w: i for i, w in enumerate(words)}
        self.crc = np.array([zlib.crc32(w) for w in words] or [0], np.uint32)
        self.length = np.array([len(w) for w in words] or [0], np.int64)
        self.paired = min(PAIR_WORDS, len(words))
        crc, length = self.crc[:self.paired], self.length[:self.paired]
        self.pairs = then(then_blank(crc)[:, None], crc[None, :], length[None, :])

    def states(self, words: list[bytes], first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """CRCs of the words, of the pairs and of the triples that end at each word.
        ``first``: the place of the word in its text, 0 and 1 having no pair or triple;
        what stands there is without meaning."""
        n = len(words)
        number = np.fromiter((self.number.get(w, -1) for w in words), np.int64, n)
        crc, length = self.crc[number], self.length[number]
        tail = np.flatnonzero(number < 0)
        if len(tail):
            crc[tail] = np.fromiter((zlib.crc32(words[i]) for i in tail), np.uint32, len(tail))
            length[tail] = np.fromiter((len(words[i]) for i in tail), np.int64, len(tail))
        two, three = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        hot = np.zeros(n, bool)
        common = (number >= 0) & (number < self.paired)
        hot[1:] = common[1:] & common[:-1]
        at = np.flatnonzero(hot)
        two[at] = self.pairs[number[at - 1], number[at]]
        long = length > LONG
        at = np.flatnonzero(~hot & ~long & (np.arange(n) > 0))
        two[at] = then(then_blank(crc[at - 1]), crc[at], length[at])
        giants = np.flatnonzero(long & (np.arange(n) > 0))
        for i in giants:
            two[i] = zlib.crc32(b" " + words[i], int(crc[i - 1]))
        at = np.flatnonzero(~long & (np.arange(n) > 1))
        three[at] = then(then_blank(two[at - 1]), crc[at], length[at])
        for i in giants[giants > 1]:
            three[i] = zlib.crc32(b" " + words[i], int(two[i - 1]))
        return crc, two, three

    def buckets(self, texts: list[str]) -> tuple[list[bytes], list[int]]:
        """Per text: the buckets of its features as 16-bit integers, and its words."""
        out, counts = [b""] * len(texts), [0] * len(texts)
        words: list[bytes] = []
        spans: list[tuple[int, int, int]] = []  # text, words, of these carried over
        for t, text in enumerate(texts):
            carried: list[bytes] = []
            for part in slabs(text):
                if part:
                    spans.append((t, len(carried) + len(part), len(carried)))
                    words += carried + part
                    counts[t] += len(part)
                    carried = (carried + part)[-2:]
                if len(words) > 500_000:
                    self._add(words, spans, out)
                    words, spans = [], []
        self._add(words, spans, out)
        return out, counts

    def _add(self, words: list[bytes], spans: list[tuple[int, int, int]], out: list[bytes]) -> None:
        if not words:
            return
        sizes = np.array([n for _, n, _ in spans])
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(words)) - np.repeat(starts, sizes)
        new = place >= np.repeat([c for _, _, c in spans], sizes)
        grid = np.stack(self.states(words, place), axis=1) % np.uint32(BUCKETS)
        real = new[:, None] & (place[:, None] >= np.arange(3))
        ends = np.cumsum(np.add.reduceat(real.sum(axis=1), starts))
        flat = grid[real].astype(np.uint16)
        begin = 0
        for (t, _, _), end in zip(spans, ends.tolist()):
            out[t] += flat[begin:end].tobytes()
            begin = end


def head_words(source: DataFrame, size: int = HEAD) -> list[bytes]:
    """The most frequent words of all texts, at most ``size``, most frequent first.
    Counts fall into classes an eighth of an octave wide; the classes that fit are taken."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for f in frames:
            for text in f["text"]:
                for words in slabs(text):
                    seen.update(words)
                    if len(seen) > 300_000:
                        yield tally(seen)
                        seen = Counter()
        yield tally(seen)

    def tally(seen: Counter) -> pd.DataFrame:
        kept = [(w, n) for w, n in seen.items() if len(w) <= LONG]
        return pd.DataFrame({"word": pd.Series([w for w, _ in kept], dtype=object), "n": pd.Series([n for _, n in kept], dtype="int64")})

    counts = written(source.select("text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
                     .withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "words")
    held, least = 0, None
    for r in counts.groupBy("class").count().orderBy(F.desc("class")).collect():  # a few hundred classes
        held += r["count"]
        if held > size:
            break
        least = r["class"]
    if least is None:
        return []
    kept = counts.where(F.col("class") >= least).select("word", "n").collect()
    return [bytes(r["word"]) for r in sorted(kept, key=lambda r: (-r["n"], bytes(r["word"])))]


def feature_buckets(source: DataFrame, head: list[bytes]) -> DataFrame:
    """(doc_id, n_words, buckets) of every row, the buckets as 16-bit integers."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Head(head)
        for f in frames:
            buckets, n = vocabulary.buckets(f["text"].tolist())
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "n_words": n, "buckets": buckets})

    return source.mapInPandas(work, "doc_id long, n_words long, buckets binary")


def bucket_totals(features: DataFrame) -> DataFrame:
    """(bucket, n): occurrences of every bucket over all texts."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for f in frames:
            for raw in f["buckets"]:
                total += np.bincount(np.frombuffer(raw, np.uint16), minlength=BUCKETS)
        yield pd.DataFrame({"bucket": np.arange(BUCKETS), "n": total})

    return features.select("buckets").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket from the totals of both sides."""
    spark = source.sparkSession
    both = (spark.range(BUCKETS).withColumnRenamed("id", "bucket")
            .join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
            .select("bucket", F.coalesce("s", F.lit(0)).cast("double").alias("s"), F.coalesce("t", F.lit(0)).cast("double").alias("t")))
    rows = both.collect()  # BUCKETS rows
    s_all, t_all = float(sum(int(r["s"]) for r in rows)), float(sum(int(r["t"]) for r in rows))
    gain = F.floor(F.lit(1000.0) * F.log((F.col("t") + 1.0) * F.lit(s_all + BUCKETS) / ((F.col("s") + 1.0) * F.lit(t_all + BUCKETS))))
    out = np.zeros(BUCKETS, np.int64)
    for r in spark.createDataFrame(rows, both.schema).select("bucket", gain.alias("gain")).collect():
        out[r["bucket"]] = r["gain"]
    return out


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: str = "42",
             key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; ``rank`` is
    null where the row is not drawn."""
    spark = docs.sparkSession
    bounded_batches(spark, 500)
    source = texts_of(docs, key, text)
    head = head_words(source)
    features = written(feature_buckets(source, head), "features")
    goal = feature_buckets(target.select(F.lit(None).cast("long").alias("doc_id"),
                                         F.coalesce(F.col(target_text).cast("string"), F.lit("")).alias("text")), head)
    gains = bucket_gains(bucket_totals(features), bucket_totals(goal))

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            parts = [np.frombuffer(raw, np.uint16) for raw in f["buckets"]]
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "n_words": f["n_words"], "n_features": [len(p) for p in parts],
                                "weight": [int(gains[p].sum()) for p in parts]})

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256),
                           1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = written(features.mapInPandas(weigh, "doc_id long, n_words long, n_features long, weight long")
                     .withColumn("score", F.col("weight") + noise).withColumn("out", (F.col("n_words") < least_words).cast("int")), "scores")
    drawn = scored.where("out = 0").count() * percent // 100
    order = [F.col("out"), F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features")]
    return (running(scored, [], order, {"place": ("sum", F.lit(1).cast("long"))})
            .select("doc_id", "n_features", "weight", "score", F.when(F.col("place") <= drawn, F.col("place")).alias("rank")))
