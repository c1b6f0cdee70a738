"""Gradient-boosted trees and isotonic regression in numpy, for bounded samples on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Trees:
    """Binary boosted trees of a fixed depth over quantile bins, by second-order logistic loss."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, l2: float = 1.0) -> None:
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        rank = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, rank)) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T, strict=True)], 1)
        mean = np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4)
        self.start, self.trees = float(np.log(mean / (1 - mean))), []
        score = np.full(len(y), self.start)
        columns, width = x.shape[1], self.bins
        for _ in range(self.rounds):
            p = sigmoid(score)
            grad, hess = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, cutoff = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                first, many = 2**level - 1, 2**level
                local = node - first
                at = (local[:, None] * columns + np.arange(columns)) * width + binned
                g = np.bincount(at.ravel(), np.repeat(grad, columns), many * columns * width).reshape(many, columns, width)
                h = np.bincount(at.ravel(), np.repeat(hess, columns), many * columns * width).reshape(many, columns, width)
                gl, hl = g.cumsum(2), h.cumsum(2)
                gt, ht = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl**2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt**2 / (ht + self.l2)
                gain = np.where((hl > 0.5) & (ht - hl > 0.5), gain, 0).reshape(many, -1)
                best = gain.argmax(1)
                for k in range(many):
                    if gain[k, best[k]] > 1e-6:
                        f, b = divmod(int(best[k]), width)
                        if b < len(self.edges[f]):
                            feature[first + k], cutoff[first + k] = f, self.edges[f][b]
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] >= cutoff[node])
            leaf = node - (2**self.depth - 1)
            g, h = np.bincount(leaf, grad, 2**self.depth), np.bincount(leaf, hess, 2**self.depth)
            value = self.rate * g / (h + self.l2)
            self.trees.append((feature, cutoff, value))
            score += value[leaf]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, cutoff, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] >= cutoff[node])
            score += value[node - (2**self.depth - 1)]
        return score


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: centres and rising values of the blocks, to be interpolated between."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # weight, weighted y, weighted score
    for s, v, w in zip(score[order], y[order], weight[order], strict=True):
        blocks.append([w, w * v, w * s])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 2] / b[:, 0], b[:, 1] / b[:, 0]


class Calibrated:
    """Trees whose raw scores are calibrated by isotonic regression on out-of-fold scores."""

    def __init__(self, folds: int = 3, **settings) -> None:
        self.folds, self.settings = folds, settings

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Calibrated:
        self.constant = float(np.average(y, weights=weight)) if len(y) else 0.0
        if len(y) < 10 or len(set(y.tolist())) < 2:  # nothing to tell apart
            self.trees = None
            return self
        part = np.arange(len(y)) % self.folds
        held = np.zeros(len(y))
        for k in range(self.folds):
            rest = part != k
            if len(set(y[rest].tolist())) < 2:
                rest = np.ones(len(y), bool)
            held[part == k] = Trees(**self.settings).fit(x[rest], y[rest], weight[rest]).raw(x[part == k])
        self.trees = Trees(**self.settings).fit(x, y, weight)
        self.at, self.value = isotonic(held, y, weight)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probabilities; the raw score breaks ties within a hundredth."""
        if self.trees is None:
            return np.full(len(x), self.constant)
        raw = self.trees.raw(x)
        return np.clip(0.99 * np.interp(raw, self.at, self.value) + 0.01 * sigmoid(raw), 0, 1)
