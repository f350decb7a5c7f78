"""Word shingles of many texts at once, as 64-bit hashes (numpy)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from riskframe.llm.common import mix

_BASE = 0x9E3779B97F4A7C15  # odd, so powers have inverses modulo 2**64


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        steps = np.full(n + 1, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    up, down = of(_BASE), of(pow(_BASE, -1, 1 << 64))
    return up, down


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (lower case, split at white space), and the number of
    the text that it stands in. One pass over the bytes of all texts: a word's
    hash is a difference of running polynomial sums."""
    raw = np.frombuffer(("\n".join(" ".join(t.lower().split()) for t in texts) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
    blank = raw <= 32
    size = 1 << max(16, len(raw).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw * up[:len(raw)], out=sums[1:], dtype=np.uint64)
    ends = np.flatnonzero(blank)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    text = np.cumsum(raw[ends] == 10) - (raw[ends] == 10)
    full = ends > starts
    starts, ends, text = starts[full], ends[full], text[full]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), text


def shingle_hashes(texts: list[str], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``words`` words, with the number of their text. A
    shorter text that has any word is one run; a text without words has none."""
    h, text = word_hashes(texts)
    counts = np.bincount(text, minlength=len(texts))
    short = (counts > 0) & (counts < words)
    parts, owner = [], []
    n = len(h) - words + 1
    if n > 0:
        inside = text[:n] == text[words - 1:]
        run = np.zeros(n, np.uint64)
        for i in range(words):
            run = (run ^ h[i:i + n]) * np.uint64(_BASE) + np.uint64(i + 1)
        parts.append(mix(run[inside]))
        owner.append(text[:n][inside])
    for t in np.flatnonzero(short):
        x = np.uint64(0)
        lo, hi = np.searchsorted(text, [t, t + 1])
        with np.errstate(over="ignore"):
            for v in h[lo:hi]:
                x = (x ^ v) * np.uint64(_BASE) + np.uint64(hi - lo)
        parts.append(mix(np.array([x], np.uint64)))
        owner.append(np.array([t]))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    shingles, owner = np.concatenate(parts), np.concatenate(owner)
    if short.any():
        order = np.argsort(owner, kind="stable")
        shingles, owner = shingles[order], owner[order]
    return shingles, owner
