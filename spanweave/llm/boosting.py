"""Gradient-boosted regression trees for two classes, in numpy, over binned features."""

from __future__ import annotations

import json

import numpy as np

BINS = 32


def _edges(values: np.ndarray) -> np.ndarray:
    """Bounds of the bins: between all values where they are few (rare flags too), else by quantiles."""
    seen = np.unique(values)
    if len(seen) <= BINS:
        return (seen[1:] + seen[:-1]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1]))


class BoostedTrees:
    """Logistic loss, second-order gains, trees of fixed depth in heap order; a tree is grown on a share of the rows."""

    def __init__(self, trees: int = 120, depth: int = 5, rate: float = 0.15, least_weight: float = 1.0, ridge: float = 1.0, share: float = 0.4) -> None:
        self.trees, self.depth, self.rate, self.least_weight, self.ridge, self.share = trees, depth, rate, least_weight, ridge, share
        self.edges: list[np.ndarray] = []
        self.grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [_edges(x[:, j]) for j in range(x.shape[1])]
        whole, n = self._bin(x), max(1, int(len(x) * self.share))
        flags = np.array([j for j, e in enumerate(self.edges) if len(e) == 1], np.int64)
        wide = [j for j, e in enumerate(self.edges) if len(e) > 1]
        base = y.mean()
        self.base = float(np.log(base / (1 - base)))
        score = np.full(len(x), self.base)
        draw = np.random.default_rng(0)
        for _ in range(self.trees):
            rows = draw.permutation(len(x))[:n]
            binned = whole[rows]
            set_flags = binned[:, flags].astype(np.float32)
            columns = [(j, binned[:, j].astype(np.int64)) for j in wide]
            p = 1 / (1 + np.exp(-score[rows]))
            g, h = y[rows] - p, p * (1 - p)
            feature = np.full((1 << self.depth) - 1, -1)
            cut = np.zeros(len(feature), np.int32)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                at = node - first
                sums = [np.bincount(at, weights=v, minlength=count) for v in (g, h)]
                best = np.full(count, 1e-6)

                def choose(j: np.ndarray | int, left: list[np.ndarray], at_cut: np.ndarray | None, best=best, sums=sums, first=first) -> None:
                    """left: sums of g and h below each cut (nodes x cuts), of one feature, or of one cut of each of many."""
                    right = [s[:, None] - v for s, v in zip(sums, left, strict=True)]
                    gain = left[0] ** 2 / (left[1] + self.ridge) + right[0] ** 2 / (right[1] + self.ridge) - (sums[0] ** 2 / (sums[1] + self.ridge))[:, None]
                    gain[(left[1] < self.least_weight) | (right[1] < self.least_weight)] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(len(k)), k]
                    better = np.flatnonzero(top > best)
                    best[better] = top[better]
                    feature[first + better] = j if isinstance(j, int) else j[k[better]]
                    cut[first + better] = k[better] if at_cut is None else 0

                if len(flags):
                    spread = np.zeros((n, 2 * count), np.float32)
                    spread[np.arange(n), at], spread[np.arange(n), count + at] = g, h
                    on = (set_flags.T @ spread).astype(float)
                    choose(flags, [sums[0][:, None] - on[:, :count].T, sums[1][:, None] - on[:, count:].T], np.zeros(1))
                for j, bins in columns:
                    key = at * BINS + bins
                    choose(j, [np.bincount(key, weights=v, minlength=count * BINS).reshape(count, BINS).cumsum(1)[:, :-1] for v in (g, h)], None)
                node = self._down(node, binned, feature, cut)
            leaf = node - len(feature)
            sums = [np.bincount(leaf, weights=v, minlength=1 << self.depth) for v in (g, h)]
            self.grown.append((feature, cut, self.rate * sums[0] / (sums[1] + self.ridge)))
            score += self._value(whole, *self.grown[-1])
        return self

    def _value(self, binned: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> np.ndarray:
        """What a tree adds to each row."""
        node = np.zeros(len(binned), np.int64)
        for _ in range(self.depth):
            node = self._down(node, binned, feature, cut)
        return value[node - len(feature)]

    @staticmethod
    def _down(node: np.ndarray, binned: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        j = feature[node]
        right = (j >= 0) & (binned[np.arange(len(node)), np.maximum(j, 0)] > cut[node])
        return 2 * node + 1 + right

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = self._bin(x)
        out = np.full(len(x), self.base)
        for tree in self.grown:
            out += self._value(binned, *tree)
        return out

    def to_json(self) -> str:
        return json.dumps({"depth": self.depth, "base": self.base, "edges": [e.tolist() for e in self.edges], "grown": [[v.tolist() for v in t] for t in self.grown]})

    @classmethod
    def from_json(cls, text: str) -> BoostedTrees:
        told = json.loads(text)
        made = cls(depth=told["depth"])
        made.base, made.edges = told["base"], [np.array(e) for e in told["edges"]]
        made.grown = [(np.array(f, np.int64), np.array(c, np.int32), np.array(v)) for f, c, v in told["grown"]]
        return made
