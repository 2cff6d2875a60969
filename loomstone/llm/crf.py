"""A linear-chain conditional random field in numpy: trained by its likelihood, decoded by Viterbi, both in batches.

A token is a set of feature numbers; a label's score is the sum of their weights. Training uses forward and backward
sums over padded batches and Adam with an L2 penalty; it is deterministic.
"""

from __future__ import annotations

import numpy as np


class Crf:
    def __init__(self, n_features: int, n_labels: int):
        self.emit = np.zeros((n_features, n_labels))
        self.move = np.zeros((n_labels, n_labels))
        self.first = np.zeros(n_labels)

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Label scores (..., labels) of tokens given as feature numbers (..., slots); feature 0 is padding without weight."""
        return self.emit[features].sum(axis=-2)

    def train(self, features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, rounds: int = 150, rate: float = 0.1, penalty: float = 1e-3) -> Crf:
        """features (sequences, time, slots), labels (sequences, time); positions past a length are ignored."""
        n, time, slots = features.shape
        valid = np.arange(time) < lengths[:, None]
        weights = [self.emit, self.move, self.first]
        memory = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        gold_moves = np.zeros_like(self.move)
        both = valid[:, 1:]
        np.add.at(gold_moves, (labels[:, :-1][both], labels[:, 1:][both]), 1)
        for step in range(1, rounds + 1):
            score = self.scores(features)
            marginal, pairs = self._expected(score, valid)
            error = -marginal
            error[np.arange(n)[:, None], np.arange(time)[None, :], labels] += 1
            error *= valid[:, :, None]
            grad_emit = np.zeros_like(self.emit)
            np.add.at(grad_emit, features.reshape(-1), np.repeat(error.reshape(-1, error.shape[-1]), slots, axis=0))
            grad_emit[0] = 0
            for w, g, (m, v) in zip(weights, (grad_emit, gold_moves - pairs, error[:, 0].sum(axis=0)), memory, strict=True):
                g = g / n - penalty * w
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.emit[0] = 0
        return self

    def _expected(self, score: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, time, k = score.shape
        forward, backward = np.empty_like(score), np.zeros_like(score)
        forward[:, 0] = self.first + score[:, 0]
        for t in range(1, time):
            step = _logsum(forward[:, t - 1, :, None] + self.move, 1) + score[:, t]
            forward[:, t] = np.where(valid[:, t, None], step, forward[:, t - 1])
        for t in range(time - 2, -1, -1):
            step = _logsum(self.move + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(valid[:, t + 1, None], step, 0)
        total = _logsum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - total[:, None, None]) * valid[:, :, None]
        pairs = np.zeros((k, k))
        for t in range(1, time):
            joint = forward[:, t - 1, :, None] + self.move + (score[:, t] + backward[:, t])[:, None, :] - total[:, None, None]
            pairs += np.exp(joint[valid[:, t]]).sum(axis=0)
        return marginal, pairs

    def viterbi(self, score: np.ndarray, lengths: np.ndarray, before: np.ndarray | None = None, after: np.ndarray | None = None) -> np.ndarray:
        """Best labels (sequences, time) of padded scores; before and after are scores of entering and of leaving."""
        n, time, k = score.shape
        back = np.zeros((n, time, k), dtype=np.int16)
        best = (self.first if before is None else before) + score[:, 0]
        for t in range(1, time):
            through = best[:, :, None] + self.move
            back[:, t] = through.argmax(axis=1)
            step = through.max(axis=1) + score[:, t]
            best = np.where((t < lengths)[:, None], step, best)
        if after is not None:
            best = best + after
        labels = np.zeros((n, time), dtype=np.int64)
        now = best.argmax(axis=1)
        for t in range(time - 1, -1, -1):
            inside = t < lengths
            labels[inside, t] = now[inside]
            if t:
                now = np.where(inside, back[np.arange(n), t, now], now)
        return labels


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis=axis)
