"""A linear-chain conditional random field in numpy, over batches of sequences.

Sequences are laid end to end: ``scores`` holds one row of label scores per
token, ``starts`` and ``lengths`` give the sequences. All passes walk the time
steps once and treat all sequences that are long enough at each step together.
Token types stand for tokens: a type has one or more feature numbers (they lie end
to end, with the place where each type's begin), and tokens refer to types."""

from __future__ import annotations

import numpy as np


class Batch:
    """Sequences in order of falling length, so step t concerns the first few."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        self.lengths, self.starts = lengths[order], starts[order]
        top = int(self.lengths[0]) if len(lengths) else 0
        # number of sequences longer than t
        self.active = len(lengths) - np.searchsorted(self.lengths[::-1], np.arange(top), "right")

    def steps(self):
        for t, n in enumerate(self.active.tolist()):
            yield t, n, self.starts[:n] + t


def marginals(scores: np.ndarray, lengths: np.ndarray, begin: np.ndarray,
              move: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Forward-backward: label probabilities per token, the sum of the log
    partition functions, and the expected transition counts."""
    batch = Batch(lengths)
    peak = scores.max(axis=1, keepdims=True) if len(scores) else scores
    emit = np.exp(scores - peak)
    turn, first = np.exp(move), np.exp(begin)
    forward, scale = np.empty_like(emit), np.ones(len(emit))
    for t, n, at in batch.steps():
        a = emit[at] * (first if t == 0 else forward[at - 1] @ turn)
        c = a.sum(axis=1)
        scale[at] = c
        forward[at] = a / c[:, None]
    log_z = float(np.log(scale).sum() + peak.sum())
    back = np.ones_like(emit)
    counts = np.zeros_like(turn)
    for t in range(len(batch.active) - 1, 0, -1):
        at = batch.starts[:batch.active[t]] + t
        b = emit[at] * back[at] / scale[at][:, None]
        back[at - 1] = b @ turn.T
        counts += (forward[at - 1].T @ b) * turn
    return forward * back, log_z, counts


def viterbi(scores: np.ndarray, lengths: np.ndarray, begin: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best label of every token's sequence."""
    batch = Batch(lengths)
    n_labels = len(begin)
    best = scores.copy()
    came = np.zeros(scores.shape, np.int8)
    for t, n, at in batch.steps():
        if t == 0:
            best[at] += begin
            continue
        before = best[at - 1]
        top = before[:, :1] + move[0]
        source = np.zeros((n, n_labels), np.int8)
        for k in range(1, n_labels):
            other = before[:, k:k + 1] + move[k]
            better = other > top
            top = np.where(better, other, top)
            source[better] = k
        best[at] += top
        came[at] = source
    path = np.zeros(len(scores), np.int8)
    some = batch.lengths > 0
    last = (batch.starts + batch.lengths - 1)[some]
    path[last] = best[last].argmax(axis=1)
    for t in range(len(batch.active) - 1, 0, -1):
        at = batch.starts[:batch.active[t]] + t
        path[at - 1] = came[at, path[at]]
    return path


class Crf:
    """Weights of emission features (``features`` x labels), of the first label
    and of label pairs."""

    def __init__(self, features: int, labels: int):
        self.weights = np.zeros((features, labels))
        self.begin, self.move = np.zeros(labels), np.zeros((labels, labels))

    def scores(self, flat: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Label scores of token types, each with one feature number at least;
        the weight of number 0 is 0."""
        return np.add.reduceat(self.weights[flat], begins, axis=0) if len(begins) else self.weights[:0]

    def fit(self, flat: np.ndarray, begins: np.ndarray, tokens: np.ndarray, lengths: np.ndarray,
            labels: np.ndarray, rounds: int = 60, rate: float = 0.15, ridge: float = 0.05) -> Crf:
        """Maximum conditional likelihood with an L2 penalty, by Adam steps over
        the whole training table. ``tokens`` are type numbers."""
        n, n_labels, n_types = len(tokens), self.weights.shape[1], len(begins)
        seq = np.repeat(np.arange(len(lengths)), lengths)
        inner = np.zeros(n, bool)
        inner[1:] = seq[1:] == seq[:-1]
        pair = np.flatnonzero(inner)
        seen_move = np.zeros_like(self.move)
        np.add.at(seen_move, (labels[pair - 1], labels[pair]), 1)
        first = np.flatnonzero(~inner)
        per_type = np.diff(np.append(begins, len(flat)))
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in (self.weights, self.begin, self.move)]
        for step in range(1, rounds + 1):
            p, _, moves = marginals(self.scores(flat, begins)[tokens], lengths, self.begin, self.move)
            wrong = -p
            wrong[np.arange(n), labels] += 1
            up = np.empty_like(self.weights)
            for k in range(n_labels):
                by_type = np.bincount(tokens, wrong[:, k], n_types)
                up[:, k] = np.bincount(flat, np.repeat(by_type, per_type), len(up))
            grads = (up, wrong[first].sum(axis=0), seen_move - moves)
            for x, g, (m, v) in zip((self.weights, self.begin, self.move), grads, state):
                g = (g - ridge * x) / max(1, len(lengths))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
            self.weights[0] = 0
        return self
