"""A calibrated ensemble of classification trees over a bounded sample, in plain arrays."""

from __future__ import annotations

import numpy as np


class TreeEnsemble:
    """Bagged trees on binned features; each split looks at a random subset of features.

    Class shares of the leaves are averaged. ``calibrate`` then maps the share
    of the winning class to how often such a winner is right (isotonic
    regression on rows that the trees did not see).
    """

    def __init__(self, trees: int = 30, depth: int = 9, bins: int = 48, least: int = 5, seed: int = 7):
        self.trees, self.depth, self.bins, self.least, self.seed = trees, depth, bins, least, seed

    def fit(self, x: np.ndarray, y: np.ndarray, classes: int) -> TreeEnsemble:
        rng = np.random.default_rng(self.seed)
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        self.classes = classes
        binned = self._bin(x)
        self.forest = []
        for _ in range(self.trees):
            rows = rng.integers(0, len(x), len(x))
            self.forest.append(self._grow(binned[rows], y[rows], rng))
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], 1).astype(np.int16)

    def _grow(self, x: np.ndarray, y: np.ndarray, rng) -> list[tuple]:
        nodes: list = []
        todo = [(np.arange(len(x)), 0, None)]
        tries = max(1, int(np.ceil(np.sqrt(x.shape[1]))) + 1)
        while todo:
            rows, depth, parent = todo.pop()
            counts = np.bincount(y[rows], minlength=self.classes).astype(float)
            at = len(nodes)
            if parent is not None:
                nodes[parent[0]][parent[1]] = at
            best = None
            if depth < self.depth and len(rows) >= 2 * self.least and counts.max() < len(rows):
                for f in rng.permutation(x.shape[1])[:tries]:
                    size = len(self.edges[f]) + 1
                    table = np.bincount(x[rows, f].astype(np.int64) * self.classes + y[rows], minlength=size * self.classes).reshape(size, -1)
                    left = np.cumsum(table, 0)[:-1].astype(float)
                    if not len(left):
                        continue
                    right = counts - left
                    n, m = left.sum(1), right.sum(1)
                    pure = (left**2).sum(1) / np.maximum(n, 1) + (right**2).sum(1) / np.maximum(m, 1)
                    pure[(n < self.least) | (m < self.least)] = -1
                    cut = int(np.argmax(pure))
                    if pure[cut] > (counts**2).sum() / len(rows) + 1e-9 and (best is None or pure[cut] > best[0]):
                        best = (pure[cut], f, cut)
            if best is None:
                nodes.append([-1, 0, -1, -1, (counts + 0.02) / (counts + 0.02).sum()])
                continue
            nodes.append([best[1], best[2], -1, -1, None])
            low = x[rows, best[1]] <= best[2]
            todo += [(rows[low], depth + 1, (at, 2)), (rows[~low], depth + 1, (at, 3))]
        return nodes

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Mean class shares of the leaves that each row reaches."""
        binned, total = self._bin(x), np.zeros((len(x), self.classes))
        for nodes in self.forest:
            feature = np.array([n[0] for n in nodes])
            cut = np.array([n[1] for n in nodes])
            child = np.array([[n[2], n[3]] for n in nodes])
            leaf = np.array([n[4] if n[4] is not None else np.zeros(self.classes) for n in nodes])
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth + 1):
                inner = feature[at] >= 0
                if not inner.any():
                    break
                rows = np.flatnonzero(inner)
                right = binned[rows, feature[at[rows]]] > cut[at[rows]]
                at[rows] = child[at[rows], right.astype(int)]
            total += leaf[at]
        return total / len(self.forest)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> TreeEnsemble:
        share = self.shares(x)
        top = share.max(1)
        right = (share.argmax(1) == y).astype(float)
        order = np.argsort(top, kind="stable")
        blocks: list[list[float]] = []  # weight, mean, last share
        for t, r in zip(top[order], right[order]):
            blocks.append([1.0, r, t])
            while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
                w, m, t2 = blocks.pop()
                blocks[-1] = [blocks[-1][0] + w, (blocks[-1][0] * blocks[-1][1] + w * m) / (blocks[-1][0] + w), t2]
        self.steps = np.array([b[2] for b in blocks]) if blocks else np.array([1.0])
        # shrunk towards one error more, so that a small block doesn't claim certainty
        self.values = np.array([(b[0] * b[1]) / (b[0] + 1.0) for b in blocks]) if blocks else np.array([0.0])
        return self

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and calibrated confidence of each row."""
        if not len(x):
            return np.empty(0, np.int64), np.empty(0)
        share = self.shares(x)
        at = np.minimum(np.searchsorted(self.steps, share.max(1), "left"), len(self.values) - 1)
        return share.argmax(1), self.values[at]
