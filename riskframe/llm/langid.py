"""Language of every word, and from these of the document, by a linear-chain
conditional random field.

Features of a word: its affixes of up to three letters, its letter n-grams of one
to three letters, and the languages in whose lexicon (the most frequent words of
the training sample that one language owns) it stands. Transitions are learned
from code-switched training sequences: runs of training documents of different
languages are laid after each other. Forward-backward gives each word a
probability per language; a document's language has the largest sum over words
with letters, and its score is the mean probability of that language.

Training rows are at most ``TRAIN_DOCS`` labelled documents per language, chosen
by hash among those whose crc32(doc_id as text) mod 3 is not 1, and at most
``TRAIN_RUNS`` runs of their words, dealt evenly over the languages and, in each,
over its documents. The other documents are never learned from.

Sequences are runs of at most ``RUN`` words, so long texts cost no more per word;
every word of a text counts. Null texts and texts without letters are ``und``
with score 0; with no labelled row at all, every text is. Ties go to the language
first in alphabetical order. A null id is not held out and not learned from. Rows
are kept as they are, repeated ones too; other columns take no part, and
``accepted`` hands them through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches, free_name, mix, pieces, WordCache
from riskframe.llm.crf import Crf, marginals

TRAIN_DOCS, TRAIN_RUNS, RUN = 200, 3000, 64
LEXICON = 400
FEATURES = 1 << 16
WORD = re.compile(r"\b[^\W\d_]++\b")  # a run of letters that touches no digit
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Iterator[list[str]]:
    """Words in lower case, as lists of bounded size; the runs of letters between
    digits if there is nothing else."""
    low = text.lower()
    for rule in (WORD, LETTERS):
        found = False
        for part in pieces(rule, low):
            # numerals such as a half sign are no letters
            if not "".join(part).isalpha():
                part = [w for w in part if any(map(str.isalpha, w))]
            if part:
                found = True
                yield part
        if found:
            return


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (never 0) of words, end to end, and where each word's
    begin. A word is put between < and >, so that its first and last n-grams
    are its affixes of one and two letters; runs of four at either end are those
    of three."""
    sizes = np.array([len(w) for w in words], np.int64) + 2
    code = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(code))  # letters up to the word's end
    padded = np.concatenate((code, np.zeros(3, np.uint64)))
    grams, key = [], np.zeros(len(code), np.uint64)
    for n in range(1, 5):
        key = (key << np.uint64(21)) ^ padded[n - 1:n - 1 + len(code)] ^ (key >> np.uint64(43))
        number = 1 + (mix(key + np.uint64(n)) % np.uint64(FEATURES - 1)).astype(np.int64)
        number[left < n] = 0
        grams.append(number)
    begins = ends - sizes
    edge = np.zeros(len(code), np.int64)
    edge[begins] = grams[3][begins]
    tail = np.maximum(ends - 4, begins)
    edge[tail] = grams[3][tail]
    # the lexicon's say stands in for the first letter of all, the mark <
    owner = np.array([lexicon.get(w, -1) for w in words], np.int64)
    grams[0][begins] = 1 + (mix((owner + 2).astype(np.uint64) << np.uint64(50)) % np.uint64(FEATURES - 1)).astype(np.int64)
    flat = np.stack([*grams[:3], edge], axis=1).ravel()
    return flat, begins * 4


class LanguageModel:
    """Languages, lexicon and field; ``scores`` serves the workers."""

    def __init__(self, languages: list[str], lexicon: dict[str, int], crf: Crf):
        self.languages, self.lexicon, self.crf = languages, lexicon, crf
        self.cache: WordCache | None = None

    def __getstate__(self):
        return {**self.__dict__, "cache": None}

    def _compute(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(words), 4096):
            scores = self.crf.scores(*features(words[i:i + 4096], self.lexicon))
            out += map(bytes, scores.astype(np.float32))
        return out

    def scores(self, words: list[str]) -> bytes:
        if self.cache is None:
            self.cache = WordCache(self._compute)
        return b"".join(self.cache.values(words))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n, k = len(texts), len(self.languages)
        parts, held, sizes = [], [], np.zeros(n, np.int64)
        for i, text in enumerate(texts):
            for words in words_of(text or ""):
                held += words
                sizes[i] += len(words)
                if len(held) > 200_000:
                    parts.append(self.scores(held))
                    held = []
        parts.append(self.scores(held))
        if not k or not sizes.sum():
            return ["und"] * n, np.zeros(n)
        emitted = np.frombuffer(b"".join(parts), np.float32).reshape(-1, k).astype(np.float64)
        runs = -(-sizes // RUN)
        lengths = np.full(runs.sum(), RUN)
        last = np.cumsum(runs)[runs > 0] - 1
        lengths[last] = (sizes - (runs - 1) * RUN)[runs > 0]
        p, _, _ = marginals(emitted, lengths, self.crf.begin, self.crf.move)
        sums = np.stack([np.bincount(np.repeat(np.arange(n), sizes), p[:, j], n) for j in range(k)], axis=1)
        best = np.round(sums, 9).argmax(axis=1)
        score = np.where(sizes > 0, sums[np.arange(n), best] / np.maximum(sizes, 1), 0.0)
        return [self.languages[b] if s else "und" for b, s in zip(best, sizes)], np.clip(score, 0.0, 1.0)


def fit(rows: list[tuple[str, str]], runs: int = TRAIN_RUNS) -> LanguageModel:
    """A model from ``(language, text)`` rows; depends only on their set."""
    rows = sorted(set(rows))
    languages = sorted({r[0] for r in rows})
    words = [[w for part in words_of(t) for w in part] for _, t in rows]
    labels = [languages.index(r[0]) for r in rows]
    # lexicon: frequent words that one language owns
    use = [Counter() for _ in languages]
    for label, ws in zip(labels, words):
        use[label].update(ws)
    share = [max(1, sum(c.values())) for c in use]
    lexicon = {}
    for k, c in enumerate(use):
        for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            if n > 1 and n / share[k] > 4 * max([0, *(o[w] / share[j] for j, o in enumerate(use) if j != k)]):
                lexicon[w] = k
    # runs of half the length in hash order; of too many, each language in turn
    # gives one, and in a language each document in turn
    half = RUN // 2
    turns: list[list] = [[] for _ in languages]
    for d, ws in enumerate(words):
        own = sorted((int(mix(np.array([zlib.crc32(f"{d} {i}".encode())], np.uint64))[0]), i) for i in range(0, len(ws), half))
        turns[labels[d]] += [(turn, order, labels[d], ws[i:i + half]) for turn, (order, i) in enumerate(own)]
    dealt = sorted((turn, *run[1:]) for of in turns for turn, run in enumerate(sorted(of)))
    pool = sorted(run[1:] for run in dealt[:runs])
    crf = Crf(FEATURES, len(languages))
    model = LanguageModel(languages, lexicon, crf)
    if not pool:
        return LanguageModel([], {}, crf)
    types: dict[str, int] = {}
    tokens, gold, lengths = [], [], []
    # two neighbours of the pool make one sequence: often of two languages
    for a in range(0, len(pool), 2):
        both = pool[a:a + 2]
        lengths.append(sum(len(x[2]) for x in both))
        for _, label, ws in both:
            tokens += [types.setdefault(w, len(types)) for w in ws]
            gold += [label] * len(ws)
    crf.fit(*features(list(types), lexicon), np.array(tokens), np.array(lengths), np.array(gold), rounds=40)
    return model


def training_rows(docs: DataFrame, per_language: int = TRAIN_DOCS, key: str = "doc_id",
                  text: str = "text", lang: str = "lang") -> list[tuple[str, str]]:
    """At most ``per_language`` labelled documents of each language."""
    part = F.crc32(F.col(key).cast("string").cast("binary")) % 3
    order = Window.partitionBy("lang").orderBy("order", "doc_id", "text")
    rows = (docs.select(F.col(lang).alias("lang"), F.col(key).alias("doc_id"), F.col(text).alias("text"),
                        part.alias("part"))
            .where("lang is not null and text is not null and part <> 1")
            .withColumn("order", F.xxhash64(F.lit(7), "doc_id")))
    chosen = (rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language))
    return [(r["lang"], r["text"]) for r in chosen.select("lang", "text").collect()]


def language(spark, model: LanguageModel, text: Column) -> Column:
    """The struct (lang_pred, score) of a text column."""
    shared = spark.sparkContext.broadcast(model)
    bounded_batches(spark)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        pred, score = shared.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": pred, "score": score})

    return predict(text.cast("string"))


def identify(docs: DataFrame, model: LanguageModel | None = None, key: str = "doc_id",
             text: str = "text", lang: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row."""
    if model is None:
        model = fit(training_rows(docs, key=key, text=text, lang=lang))
    held = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return (docs.select(F.col(key).alias("doc_id"), held.alias("held_out"),
                        language(docs.sparkSession, model, F.col(text)).alias("found"))
            .select("doc_id", "held_out", "found.lang_pred", "found.score"))


def accepted(docs: DataFrame, least: float = 0.4, key: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """The rows, with all their columns, whose text has a language: not ``und``,
    and a score of at least ``least``."""
    model = fit(training_rows(docs, key=key, text=text, lang=lang))
    found = free_name(docs, "__language")
    return (docs.withColumn(found, language(docs.sparkSession, model, F.col(text)))
            .where((F.col(f"{found}.lang_pred") != "und") & (F.col(f"{found}.score") >= least)).drop(found))
