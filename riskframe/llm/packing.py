"""Order-preserving packing of documents into training windows.

Documents are taken in order of their id (null first; ties by the first 64
characters of the text, then by its hash) and laid end to end. Window cuts are
chosen by dynamic programming over candidate positions: the end of a document
(free), the end of a sentence (``SENTENCE`` tokens of penalty) and, where neither comes for ``STRIDE`` tokens, positions ``STRIDE``
apart (``HARD`` tokens of penalty). The cost of a plan is its padding, plus the
penalties of its cuts, plus ``WINDOW`` per window. A window is padded to
``width`` unless its length is a power of two, which needs no padding.

With P the running token count, the best cost up to candidate j is::

    best[j] = penalty[j] + WINDOW + min( width - P[j] + min(best[i] + P[i]),  best[i'] )

where i runs over the candidates with P[j] - P[i] <= width (a monotone queue
yields that minimum in constant amortised time) and i' over the at most eleven
candidates exactly a power of two before j.

Each task packs its own range of documents, some ``RUN_TOKENS`` tokens at a
time, so memory is bounded and at most one window per run ends early. A document
may lie in several windows; every id lies in exactly one piece. Null and empty
texts hold the end id alone. Repeated rows are separate documents; an empty
table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import bounded_batches, in_order, texts_of
from riskframe.llm.encode import Encoder, encoder

SENTENCE, HARD, WINDOW = 2.0, 24.0, 8.0
STRIDE = 64
RUN_TOKENS = 1 << 19
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, ids_crc32 long")


def sentence_ends(enc: Encoder) -> np.ndarray:
    """For each id, whether its text closes a sentence or a line."""
    texts = [enc.tokenizer.decode([i], skip_special_tokens=False) for i in range(enc.size)]
    return np.array([t.endswith((".", "!", "?", "\n")) for t in texts])


def candidates(flat: np.ndarray, part_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions in documents laid end to end (counts of ids before the cut)
    and their penalties."""
    mark = ends[flat]
    mark[part_ends - 1] = True
    at = np.flatnonzero(mark) + 1
    cost = np.full(len(at), SENTENCE)
    cost[np.searchsorted(at, part_ends)] = 0.0
    before = np.concatenate(([0], at[:-1]))
    extra = (at - before - 1) // STRIDE
    if extra.any():
        number = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1
        hard = np.repeat(before, extra) + STRIDE * number
        cuts = np.concatenate((at, hard))
        order = np.argsort(cuts, kind="stable")
        return cuts[order], np.concatenate((cost, np.full(len(hard), HARD)))[order]
    return at, cost


def choose_cuts(cuts: list[int], penalty: list[float], width: int) -> list[int]:
    """Ends of the windows of the cheapest plan. ``cuts`` ascend, the last is the
    number of tokens, and no two neighbours (nor the first and 0) are over
    ``width`` apart."""
    pos = [0, *cuts]
    best, back = [0.0] * len(pos), [0] * len(pos)
    # candidates that lie a power of two before a later one
    at = np.array(pos)
    ends, starts = [], []
    for k in range(width.bit_length()):
        i = np.searchsorted(at, at - (1 << k))
        hit = np.flatnonzero(at[i] == at - (1 << k))
        ends.append(hit)
        starts.append(i[hit])
    end = np.concatenate(ends)
    order = np.argsort(end, kind="stable")
    exact = np.concatenate(starts)[order].tolist()
    bound = np.searchsorted(end[order], np.arange(len(pos) + 1)).tolist()
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # (best + P, candidate), costs ascending
    for j in range(1, len(pos)):
        p = pos[j]
        while pos[queue[0][1]] < p - width:
            queue.popleft()
        key, i = queue[0]
        cost = key + width - p
        for h in exact[bound[j]:bound[j + 1]]:
            if best[h] < cost:
                cost, i = best[h], h
        cost += WINDOW + penalty[j - 1]
        best[j], back[j] = cost, i
        key = cost + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out, j = [], len(pos) - 1
    while j:
        out.append(pos[j])
        j = back[j]
    return out[::-1]


class Packer:
    """Packs a task's documents; ``add`` and ``close`` return finished pieces as
    rows ``(doc_id, start, length, doc_tokens, sequence_id, offset, ids)``."""

    def __init__(self, ends: np.ndarray, width: int, first_sequence: int):
        self.ends, self.width, self.sequence = ends, width, first_sequence
        self.parts: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        rows, start, total = [], 0, len(ids)
        while start < total:
            stop = min(total, start + RUN_TOKENS)
            if stop < total:  # a very long document is taken in parts
                at = np.flatnonzero(self.ends[ids[start:stop]])
                stop = start + int(at[-1]) + 1 if len(at) else stop
            self.parts.append((doc_id, start, ids[start:stop], total))
            self.held += stop - start
            start = stop
            if self.held >= RUN_TOKENS:
                rows += self.close()
        return rows

    def close(self) -> list[tuple]:
        if not self.parts:
            return []
        part_ends = np.cumsum([len(p[2]) for p in self.parts])
        cuts, penalty = candidates(np.concatenate([p[2] for p in self.parts]), part_ends, self.ends)
        windows = choose_cuts(cuts.tolist(), penalty.tolist(), self.width)
        rows, k, opened, b = [], 0, 0, 0
        for doc_id, start, ids, total in self.parts:
            done, size = 0, len(ids)
            while done < size:
                n = min(size - done, windows[k] - b - done)
                rows.append((doc_id, start + done, n, total, self.sequence, b + done - opened, ids[done:done + n]))
                done += n
                if b + done == windows[k]:
                    opened, k, self.sequence = windows[k], k + 1, self.sequence + 1
            b += size
        self.parts, self.held = [], 0
        return rows


def pack(docs: DataFrame, tokenizer_path: str, width: int = 1024, end_id: int = 0,
         key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: the columns of ``PIECES`` and, ``with_ids``, ``ids`` as
    little-endian unsigned 32-bit integers, which the checksum is of. Texts are
    range-partitioned (``in_order``); that is the only shuffle."""
    if width < STRIDE or width & (width - 1):
        raise ValueError(f"width must be a power of two, at least {STRIDE}")
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        source = f.read()
    shared = spark.sparkContext.broadcast((source, sentence_ends(encoder(source))))
    bounded_batches(spark)
    ordered = in_order(texts_of(docs, key, text)).withColumn("shard", F.spark_partition_id())
    schema = PIECES + ", ids binary" * with_ids
    names = [x.split()[0] for x in PIECES.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        wide = [r[6].astype("<u4") for r in rows]
        out = pd.DataFrame([(*r[:6], zlib.crc32(w)) for r, w in zip(rows, wide)], columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        if with_ids:
            out["ids"] = [w.tobytes() for w in wide]
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, packer = None, None
        for f in frames:
            if enc is None:
                enc = encoder(shared.value[0])
                packer = Packer(shared.value[1], width, int(f["shard"].iloc[0]) << 40)
                end = np.array([end_id], enc.dtype).tobytes()
            rows = []
            for doc_id, text in zip(f["doc_id"], f["text"]):
                ids = np.frombuffer(enc.ids(text) + end, enc.dtype)
                rows += packer.add(None if pd.isna(doc_id) else int(doc_id), ids)
            if rows:
                yield frame(rows)
        if packer is not None:
            rows = packer.close()
            if rows:
                yield frame(rows)

    return ordered.mapInPandas(run, schema)
