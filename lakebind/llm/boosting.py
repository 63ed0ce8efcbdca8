"""Gradient-boosted trees for yes-or-no questions, small enough to be sent to every task."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Trees of a fixed depth fitted to the gradient of the logistic loss, over features cut into quantile bins."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: int = 20, rows: int = 20_000):
        """``rows`` is how many rows each tree sees at most, drawn anew for every tree."""
        self.rounds, self.depth, self.rate, self.bins, self.least, self.rows = rounds, depth, rate, bins, least, rows
        self.edges: list[np.ndarray] = []
        self.trees: list[list[tuple[int, int, float]]] = []
        self.start = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        binned, share = self._binned(x), np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score, dice = np.full(len(y), self.start), np.random.default_rng(3)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            seen = dice.choice(len(y), self.rows, replace=False) if len(y) > self.rows else slice(None)
            tree = self._grow(binned[seen], (y - p)[seen], (p * (1 - p))[seen])
            self.trees.append(tree)
            score += self._tree(tree, binned)
        return self

    def _grow(self, binned: np.ndarray, slope: np.ndarray, curve: np.ndarray) -> list[tuple[int, int, float]]:
        """Nodes as (feature, bin, value) in heap order; feature -1 is a leaf."""
        nodes: list[tuple[int, int, float]] = [(-1, 0, 0.0)] * (2 ** (self.depth + 1) - 1)
        members = {0: np.arange(len(slope))}
        for at in range(len(nodes)):
            own = members.pop(at, None)
            if own is None:
                continue
            s, c = slope[own], curve[own]
            nodes[at] = (-1, 0, self.rate * float(s.sum() / (c.sum() + 1.0)))
            if 2 * at + 2 >= len(nodes) or len(own) < 2 * self.least:
                continue
            best = (1e-6, -1, 0)
            mine = binned[own]
            for k in range(binned.shape[1]):
                size = len(self.edges[k]) + 1
                column = mine[:, k]
                n = np.cumsum(np.bincount(column, minlength=size))[:-1]
                a, b = (np.cumsum(np.bincount(column, weights=w, minlength=size))[:-1] for w in (s, c))
                gain = a**2 / (b + 1) + (s.sum() - a) ** 2 / (c.sum() - b + 1) - s.sum() ** 2 / (c.sum() + 1)
                gain = np.where((n >= self.least) & (len(own) - n >= self.least), gain, -1)
                if len(gain) and gain.max() > best[0]:
                    best = (float(gain.max()), k, int(gain.argmax()))
            if best[1] >= 0:
                nodes[at] = (best[1], best[2], nodes[at][2])
                left = binned[own, best[1]] <= best[2]
                members[2 * at + 1], members[2 * at + 2] = own[left], own[~left]
        return nodes

    def _tree(self, nodes: list[tuple[int, int, float]], binned: np.ndarray) -> np.ndarray:
        feature, cut, value = (np.array(c) for c in zip(*nodes))
        at = np.zeros(len(binned), dtype=np.int64)
        rows = np.arange(len(binned))
        for _ in range(self.depth):
            inner = feature[at] >= 0
            right = binned[rows, np.maximum(feature[at], 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return value[at]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        binned = self._binned(x)
        return 1 / (1 + np.exp(-(self.start + sum(self._tree(t, binned) for t in self.trees))))
