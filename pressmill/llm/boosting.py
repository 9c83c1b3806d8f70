"""Boosted lookup tables and trees on binned features, and isotonic calibration.

Small models fitted in numpy on a bounded sample; scoring is array indexing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cuts of each feature at its quantiles; equal values share a bin."""
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if len(c) else np.zeros(0) for c in x.T]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "left") for c, e in zip(x.T, edges)], axis=1) if len(edges) else np.zeros((len(x), 0), int)


def start_value(y: np.ndarray) -> float:
    """Log-odds of the labels; without rows, of one half."""
    p = (y.sum() + 0.5) / (len(y) + 1.0)
    return float(np.log(p / (1 - p)))


def _leaves(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float, least: float) -> np.ndarray:
    """Values of a shallow tree on one feature: the bins cut greedily into at most ``leaves`` runs."""
    cg, ch = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])
    gain = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    runs = [(0, len(g))]
    while len(runs) < leaves:
        best = (1e-9, None, None)
        for r, (a, b) in enumerate(runs):
            if b - a < 2:
                continue
            c = np.arange(a + 1, b)
            got = gain(a, c) + gain(c, b) - gain(a, b)
            got = np.where((ch[c] - ch[a] >= least) & (ch[b] - ch[c] >= least), got, -1.0)
            k = int(got.argmax())
            if got[k] > best[0]:
                best = (float(got[k]), r, int(c[k]))
        if best[1] is None:
            break
        a, b = runs.pop(best[1])
        runs += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in runs:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[np.ndarray, float]:
    """Values of a tree with one cut on either feature of a pair, and its gain."""
    cum = lambda m: np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    cg, ch, (ni, nj) = cum(g), cum(h), g.shape
    if ni < 2 or nj < 2:
        return np.zeros(g.shape), 0.0
    a, b = np.arange(1, ni)[:, None], np.arange(1, nj)[None, :]
    total, parts = np.zeros((ni - 1, nj - 1)), []
    for i0, i1, j0, j1 in ((0, a, 0, b), (0, a, b, nj), (a, ni, 0, b), (a, ni, b, nj)):
        sg = cg[i1, j1] - cg[i0, j1] - cg[i1, j0] + cg[i0, j0]
        sh = ch[i1, j1] - ch[i0, j1] - ch[i1, j0] + ch[i0, j0]
        parts.append(np.broadcast_to(np.where(sh >= least, sg / (sh + ridge), 0.0), total.shape))
        total = total + np.where(sh >= least, sg**2 / (sh + ridge), 0.0)
    i, j = np.unravel_index(total.argmax(), total.shape)
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = parts[0][i, j], parts[1][i, j]
    out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = parts[2][i, j], parts[3][i, j]
    return out, float(total[i, j])


@dataclass
class AdditiveModel:
    """A generalised additive model: a table per feature and a table per chosen pair, summed on the logit scale."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        b = to_bins(x, self.edges)
        z = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            z += t[b[:, f]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            z += t[b[:, i], b[:, j]]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x))


def fit_additive(
    x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, pair_rounds: int = 40, n_pairs: int = 6, rate: float = 0.15, leaves: int = 4, ridge: float = 2.0, least: float = 1.0
) -> AdditiveModel:
    """Cyclic boosting: in each round every feature in turn gets one shallow tree on what is left; then the pairs likewise.

    Pairs are those whose two-way tree explains most of what the single tables leave.
    """
    edges = bin_edges(x, bins)
    b, y = to_bins(x, edges), y.astype(float)
    size = [len(e) + 1 for e in edges]
    model = AdditiveModel(edges, start_value(y), [np.zeros(n) for n in size])
    if not len(y):
        return model
    z = np.full(len(y), model.base)
    for _ in range(rounds):
        for f, n in enumerate(size):
            p = sigmoid(z)
            tree = rate * _leaves(np.bincount(b[:, f], y - p, n), np.bincount(b[:, f], p * (1 - p), n), leaves, ridge, least)
            model.tables[f] += tree
            z += tree[b[:, f]]

    def tree(i: int, j: int) -> tuple[np.ndarray, float]:
        p, cell, shape = sigmoid(z), b[:, i] * size[j] + b[:, j], (size[i], size[j])
        g, h = (np.bincount(cell, v, size[i] * size[j]).reshape(shape) for v in (y - p, p * (1 - p)))
        return _quadrants(g, h, ridge, least)

    gains = sorted(((tree(i, j)[1], i, j) for i in range(len(size)) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for _, i, j in gains[:n_pairs]]
    model.pair_tables = [np.zeros((size[i], size[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            step = rate * tree(i, j)[0]
            model.pair_tables[k] += step
            z += step[b[:, i], b[:, j]]
    return model


@dataclass
class TreeModel:
    """Boosted trees of one depth: for each node the feature and bin it splits by, for each leaf a value."""

    edges: list[np.ndarray]
    base: float
    depth: int
    features: np.ndarray
    cuts: np.ndarray
    values: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        b, z, rows = to_bins(x, self.edges), np.full(len(x), self.base), np.arange(len(x))
        for f, c, v in zip(self.features, self.cuts, self.values):
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, f[node]] > c[node])
            z += v[node - (2**self.depth - 1)]
        return z


def fit_trees(x: np.ndarray, y: np.ndarray, bins: int = 48, n_trees: int = 80, depth: int = 3, rate: float = 0.15, ridge: float = 2.0, least: float = 1.0) -> TreeModel:
    """Gradient-boosted trees by histograms; a node without a gainful split sends all rows left."""
    edges = bin_edges(x, bins)
    b, y, inner = to_bins(x, edges), y.astype(float), 2**depth - 1
    base, z = start_value(y), np.full(len(y), start_value(y))
    features, cuts, values = [], [], []
    for _ in range(n_trees if len(y) else 0):
        p = sigmoid(z)
        g, h = y - p, p * (1 - p)
        node, f_of, c_of = np.zeros(len(y), int), np.zeros(inner, int), np.full(inner, 1 << 30)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            best = np.full(n, 1e-9)
            for f, e in enumerate(edges):
                m = len(e) + 1
                if m < 2:
                    continue
                cell = (node - first) * m + b[:, f]
                cg, ch = (np.bincount(cell, v, n * m).reshape(n, m).cumsum(1) for v in (g, h))
                tg, th = cg[:, -1:], ch[:, -1:]
                gain = cg**2 / (ch + ridge) + (tg - cg) ** 2 / (th - ch + ridge) - tg**2 / (th + ridge)
                gain = np.where((ch >= least) & (th - ch >= least), gain, -1.0)
                k = gain.argmax(1)
                got = gain[np.arange(n), k]
                better = got > best
                best[better] = got[better]
                f_of[first : first + n][better], c_of[first : first + n][better] = f, k[better]
            node = 2 * node + 1 + (b[np.arange(len(y)), f_of[node]] > c_of[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        z += value[leaf]
        features.append(f_of), cuts.append(c_of), values.append(value)
    return TreeModel(edges, base, depth, np.array(features, int), np.array(cuts, int), np.array(values))


@dataclass
class Isotonic:
    """A rising map from logits to chances, straight between the centres of its pools."""

    at: np.ndarray
    to: np.ndarray

    def __call__(self, z: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return sigmoid(z)
        # A slight slope keeps the order of scores inside a pool.
        return np.clip(0.998 * np.interp(z, self.at, self.to) + 0.002 * sigmoid(z), 0.0, 1.0)


def fit_isotonic(z: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pools of adjacent violators over the rows by logit."""
    order = np.argsort(z, kind="stable")
    pools: list[list[float]] = []  # sum of labels, rows, sum of logits
    for v, t in zip(z[order], y[order]):
        pools.append([float(t), 1.0, float(v)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return Isotonic(np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools]))
