"""Token counts by heap-and-linked-list byte-pair merging.

The counts equal those of a sentencepiece BPE model with byte fallback, but no
identifier is produced: a piece of text starts as one symbol per character in a
doubly linked list; a heap yields the best-ranked adjacent pair (ties: the
leftmost), the pair merges, and its new neighbours enter the heap. The count is
the number of initial symbols minus the number of merges, plus the extra bytes
of characters that the vocabulary lacks.

A text is cut only where no merge can reach across: a cut is safe when no piece
of the vocabulary contains the two characters next to each other. The pieces so
found repeat a lot, so each task merges a piece once and remembers its count.

Empty and null texts count 0 tokens. Rows are kept as they are (repeated rows
and null keys included), and columns other than key and text take no part.
"""

from __future__ import annotations

import heapq
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import WordCache, bounded_batches, pieces, texts_of

SPACE = "▁"  # the model's sign for a blank


class MergeCounter:
    """Counts of one model; lives in a worker for as long as that runs."""

    def __init__(self, model_bytes: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(model_bytes)
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if (trainer.model_type != trainer.BPE or not trainer.byte_fallback
                or spec.precompiled_charsmap or spec.remove_extra_whitespaces
                or trainer.treat_whitespace_as_suffix):
            raise ValueError("needs a BPE model with byte fallback and identity normalisation")
        normal = model.SentencePiece.NORMAL
        if any(p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not covered")
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == normal}
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.pattern = self._cuts({a + b for p in self.rank for a, b in zip(p, p[1:])})
        self.cache = WordCache(lambda words: [self.merged(w) for w in words])

    @staticmethod
    def _cuts(pairs: set[str]) -> re.Pattern:
        """The pattern whose matches cover a text and end at safe cuts only."""
        if any(p[1] == SPACE != p[0] for p in pairs):
            raise ValueError("a piece of this model holds an inner blank")
        if any("\n" in p for p in pairs):
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        letters = "".join(c for c in map(chr, range(0x41, 0x250))
                          if c.isalpha() and c + "." not in pairs and c + "," not in pairs)
        s = SPACE
        return re.compile(rf"{s}*[{letters}]+(?=[{s}.,\n]|\Z)|[.,]+(?=[{s}\n]|\Z)|\n"
                          rf"|{s}*[^{s}\n]+|{s}+")

    def merged(self, word: str) -> int:
        rank = self.rank
        sym = list(word)
        n = len(sym)
        if n > 1:
            heap = []
            for i in range(n - 1):
                pair = sym[i] + sym[i + 1]
                if pair in rank:
                    heap.append((rank[pair], i, pair))
            heapq.heapify(heap)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            left = n
            pop, push = heapq.heappop, heapq.heappush
            while heap:
                _, i, pair = pop(heap)
                j = after[i]
                # stale entries: a side has merged since
                if j >= n or not sym[i] or sym[i] + sym[j] != pair or not sym[j]:
                    continue
                sym[i], sym[j] = pair, ""
                left -= 1
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    grown = pair + sym[k]
                    if grown in rank:
                        push(heap, (rank[grown], i, grown))
                h = before[i]
                if h >= 0:
                    grown = sym[h] + pair
                    if grown in rank:
                        push(heap, (rank[grown], h, grown))
            n = left
        # what stayed a single unknown character falls back to its bytes
        return n + sum(len(s.encode()) - 1 for s in sym if s and s not in rank)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = self.prefix + text.replace(" ", SPACE)
        return sum(sum(self.cache.values(part)) for part in pieces(self.pattern, text))


_COUNTERS: dict[int, MergeCounter] = {}


def _counter(model_bytes: bytes) -> MergeCounter:
    key = hash(model_bytes)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = MergeCounter(model_bytes)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row. The model file
    (well under 1 MB) is read on the driver and travels with the function."""
    with open(model_path, "rb") as f:
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        counter = _counter(shared.value)
        return texts.map(counter.count).astype("int64")

    counted = texts_of(docs, key, text).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        n_tokens("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
