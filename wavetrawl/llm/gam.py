"""A generalised additive model with pairwise terms, boosted in turns over the features.

Each feature is cut into bins; each term (one feature, or two) is a table of additions to the log odds. A round
visits the terms one after the other and fits a shallow tree to the gradient on that term's bins, whose leaf
values, shrunk, are added to its table. Scoring is one lookup and addition per term.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np


@dataclass(frozen=True)
class AdditiveModel:
    edges: list[np.ndarray]
    intercept: float
    single: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, features: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, features[:, i], side="right") for i, e in enumerate(self.edges)], axis=1)

    def log_odds(self, features: np.ndarray) -> np.ndarray:
        at = self.bins(features)
        total = np.full(len(features), self.intercept)
        for i, table in enumerate(self.single):
            total += table[at[:, i]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[at[:, i], at[:, j]]
        return total

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(features), -30, 30)))


def _gain(gradient, weight, damping):
    return gradient * gradient / (weight + damping)


def _best_cut(gradient: np.ndarray, weight: np.ndarray, damping: float, least: float) -> tuple[float, int]:
    """The gain and place of the best split of consecutive bins; place 0 if none helps."""
    if len(gradient) < 2:
        return 0.0, 0
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    all_g, all_w = gradient.sum(), weight.sum()
    gain = _gain(left_g, left_w, damping) + _gain(all_g - left_g, all_w - left_w, damping) - _gain(all_g, all_w, damping)
    gain[(left_w < least) | (all_w - left_w < least)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1 if gain[at] > 1e-12 else 0


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, damping: float, least: float) -> np.ndarray:
    """Leaf values per bin of a tree with at most ``leaves`` leaves, grown by best gain."""
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        cuts = [(*_best_cut(gradient[a:b], weight[a:b], damping, least), a, b) for a, b in parts]
        gain, at, a, b = max(cuts)
        if not at:
            break
        parts.remove((a, b))
        parts += [(a, a + at), (a + at, b)]
    values = np.zeros(len(gradient))
    for a, b in parts:
        values[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + damping)
    return values


def _quadrants(gradient: np.ndarray, weight: np.ndarray, damping: float) -> tuple[float, np.ndarray]:
    """Gain and values of the best four-leaf tree that cuts both axes once."""
    cum = [np.cumsum(np.cumsum(x, axis=0), axis=1) for x in (gradient, weight)]

    def corners(c):
        low_low = c[:-1, :-1]
        low_high, high_low = c[:-1, -1:] - low_low, c[-1:, :-1] - low_low
        return low_low, low_high, high_low, c[-1, -1] - low_low - low_high - high_low

    if min(gradient.shape) < 2:
        return 0.0, np.zeros_like(gradient)
    g, w = corners(cum[0]), corners(cum[1])
    gain = sum(_gain(x, y, damping) for x, y in zip(g, w)) - _gain(gradient.sum(), weight.sum(), damping)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    leaf = [x[i, j] / (y[i, j] + damping) for x, y in zip(g, w)]
    values = np.empty_like(gradient)
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = leaf
    return float(gain[i, j]), values


def fit(
    features: np.ndarray,
    label: np.ndarray,
    max_bins: int = 48,
    rounds: int = 120,
    pair_count: int = 6,
    pair_rounds: int = 40,
    leaves: int = 4,
    rate: float = 0.15,
    damping: float = 1.0,
    least: float = 2.0,
) -> AdditiveModel:
    """Fit on a sample. Labels of one kind only, or none, give the constant prior of that sample."""
    n, width = features.shape
    share = (label.sum() + 0.5) / (n + 1.0)
    intercept = float(np.log(share / (1 - share)))
    steps = np.linspace(0, 1, max_bins + 1)[1:-1]
    edges = [np.unique(np.quantile(features[:, i], steps)) if n else np.zeros(0) for i in range(width)]
    model = AdditiveModel(edges, intercept, [np.zeros(len(e) + 1) for e in edges], [], [])
    if n == 0 or label.min() == label.max():
        return model
    at = model.bins(features)
    total = np.full(n, intercept)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return label - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for i, table in enumerate(model.single):
            g, w = (np.bincount(at[:, i], x, len(table)) for x in slope())
            step = rate * _tree(g, w, leaves, damping, least * 0.05)
            table += step
            total += step[at[:, i]]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.single[i]), len(model.single[j])
        cell = at[:, i] * shape[1] + at[:, j]
        g, w = (np.bincount(cell, x, shape[0] * shape[1]).reshape(shape) for x in slope())
        return g, w

    ranked = sorted(((_quadrants(*grid(i, j), damping)[0], i, j) for i, j in combinations(range(width), 2)), reverse=True)
    chosen = [(i, j) for gain, i, j in ranked[:pair_count] if gain > 0]
    model.pairs.extend(chosen)
    model.pair_tables.extend(np.zeros((len(model.single[i]), len(model.single[j]))) for i, j in chosen)
    for _ in range(pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            step = rate * _quadrants(*grid(i, j), damping)[1]
            table += step
            total += step[at[:, i], at[:, j]]
    return model
