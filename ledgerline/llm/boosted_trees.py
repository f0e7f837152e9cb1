"""Gradient-boosted trees for several classes, over binned features."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Boosted:
    """Complete trees of ``depth`` questions (is the bin of a feature above a threshold), one for each class a round;
    softmax loss, Newton steps, a round's trees from a sample of the rows."""

    classes: int
    rounds: int = 40
    depth: int = 4
    rate: float = 0.25
    share: float = 0.25  # of the rows, drawn anew for every round
    l2: float = 1.0
    edges: list[np.ndarray] = field(default_factory=list)
    start: np.ndarray | None = None
    trees: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
        for f in np.flatnonzero(((x == 0) | (x == 1)).all(axis=0)):  # rare marks too
            self.edges[f] = np.zeros(1)
        bins = self.binned(x).astype(np.int64)
        binary = [f for f, e in enumerate(self.edges) if len(e) == 1]
        marks = (bins[:, binary] > 0).astype(float)
        target = np.eye(self.classes)[y]
        self.start = np.log(target.mean(axis=0) + 1e-6)
        raw = np.tile(self.start, (len(x), 1))
        draw = np.random.default_rng(len(x))
        for _ in range(self.rounds):
            at = np.sort(draw.choice(len(x), max(1, int(self.share * len(x))), replace=False))
            some, some_marks = np.asfortranarray(bins[at]), marks[at]
            p = _softmax(raw[at])
            for k in range(self.classes):
                tree = self._tree(some, binary, some_marks, p[:, k] - target[at, k], p[:, k] * (1 - p[:, k]))
                self.trees.append((k, *tree))
                raw[:, k] += tree[2][self._leaf(bins, tree)]
        return self

    def _gain(self, gl: np.ndarray, hl: np.ndarray, ga: np.ndarray, ha: np.ndarray) -> np.ndarray:
        gain = gl**2 / (hl + self.l2) + (ga - gl) ** 2 / (ha - hl + self.l2) - ga**2 / (ha + self.l2)
        gain[(hl < 0.5) | (ha - hl < 0.5)] = 0
        return gain

    def _tree(self, bins: np.ndarray, binary: list[int], marks: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = 2**self.depth - 1
        feature, above = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)  # BINS: all rows go left
        node = np.zeros(len(g), np.int64)
        rows = np.arange(len(g))
        for level in range(self.depth):
            n, first = 2**level, 2**level - 1
            here = node - first
            ga, ha = (np.bincount(here, w, n)[:, None] for w in (g, h))
            best = np.full(n, 1e-3)

            def better(gain: np.ndarray, f: np.ndarray, at: np.ndarray, best: np.ndarray = best, first: int = first, n: int = n) -> None:
                wins = gain > best
                best[wins] = gain[wins]
                feature[first : first + n][wins] = f[wins]
                above[first : first + n][wins] = at[wins]

            if binary:  # sums of all marks at once: a product of matrices
                split = []
                for w, all_ in ((g, ga), (h, ha)):
                    by_node = np.zeros((len(g), n))
                    by_node[rows, here] = w
                    split.append(all_ - by_node.T @ marks)
                gain = self._gain(*split, ga, ha)
                top = gain.argmax(axis=1)
                better(gain[np.arange(n), top], np.array(binary)[top], np.zeros(n, np.int64))
            for f, e in enumerate(self.edges):
                if len(e) < 2:
                    continue
                gl, hl = (np.bincount(here * BINS + bins[:, f], w, n * BINS).reshape(n, BINS).cumsum(axis=1) for w in (g, h))
                gain = self._gain(gl, hl, ga, ha)
                at = gain.argmax(axis=1)
                better(gain[np.arange(n), at], np.full(n, f), at)
            node = 2 * node + 1 + (bins[rows, feature[node]] > above[node])
        leaf = node - inner
        gs, hs = (np.bincount(leaf, w, inner + 1) for w in (g, h))
        return feature, above, -self.rate * gs / (hs + self.l2)

    def _leaf(self, bins: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        rows, node = np.arange(len(bins)), np.zeros(len(bins), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (bins[rows, tree[0][node]] > tree[1][node])
        return node - (2**self.depth - 1)

    def _leaves(self, columns: dict[int, np.ndarray], feature: np.ndarray, above: np.ndarray) -> np.ndarray:
        """As ``_leaf``, from the bins of each feature: all questions are asked of all rows, which is less work than to
        look up the one question that a row comes to."""
        asked = [columns[f] > t for f, t in zip(feature.tolist(), above.tolist(), strict=True)]
        went: list[np.ndarray] = []
        leaf = np.zeros(len(asked[0]), np.uint8)
        for level in range(self.depth):
            left = asked[2**level - 1 : 2 ** (level + 1) - 1]
            for right in went:
                half = len(left) // 2
                left = [no ^ (right & (no ^ yes)) for no, yes in zip(left[:half], left[half:], strict=True)]
            went.append(left[0])
            leaf = 2 * leaf + left[0]
        return leaf

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        columns = {}
        for f in sorted({int(f) for _, feature, _, _ in self.trees for f in feature}):
            e = self.edges[f]
            columns[f] = (x[:, f] > e[0]).view(np.uint8) if len(e) == 1 else np.searchsorted(e, x[:, f], side="left").astype(np.uint8)
        raw = np.repeat(self.start[:, None], len(x), axis=1)
        for k, feature, above, value in self.trees:
            raw[k] += value[self._leaves(columns, feature, above)]
        return np.log(np.maximum(_softmax(np.ascontiguousarray(raw.T)), 1e-9))


def _softmax(raw: np.ndarray) -> np.ndarray:
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
