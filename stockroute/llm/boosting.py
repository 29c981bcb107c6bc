"""Gradient-boosted trees on numpy arrays, with probabilities calibrated on held-out rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH, BINS = 3, 24


@dataclass
class Trees:
    """Complete trees of ``DEPTH`` levels: split feature, threshold, leaf values;
    ``scale`` and ``shift`` map a score to a log-odds."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray
    base: float
    scale: float = 1.0
    shift: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            out += leaf[node - (2 ** DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.score(x) + self.shift)))


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree by exact search over the candidate cuts, second-order gain."""
    inner = 2 ** DEPTH - 1
    feature, limit, leaf = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
    rows = {0: np.arange(len(x))}
    for node in range(inner):
        mine = rows[node]
        g, h = grad[mine], hess[mine]
        best = 1e-6
        for f, values in enumerate(cuts):
            if not len(values) or not len(mine):
                continue
            place = np.searchsorted(values, x[mine, f], "left")
            left_g = np.cumsum(np.bincount(place, g, len(values) + 1))[:-1]
            left_h = np.cumsum(np.bincount(place, h, len(values) + 1))[:-1]
            right_g, right_h = g.sum() - left_g, h.sum() - left_h
            gain = left_g ** 2 / (left_h + 1) + right_g ** 2 / (right_h + 1) - g.sum() ** 2 / (h.sum() + 1)
            gain[(left_h < 1e-3) | (right_h < 1e-3)] = -1
            k = int(gain.argmax())
            if gain[k] > best:
                best, feature[node], limit[node] = gain[k], f, values[k]
        right = x[mine, feature[node]] > limit[node]
        rows[2 * node + 1], rows[2 * node + 2] = mine[~right], mine[right]
    for k in range(inner + 1):
        mine = rows[inner + k]
        leaf[k] = grad[mine].sum() / (hess[mine].sum() + 1)
    return feature, limit, leaf


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.3) -> Trees:
    """Trees for labels ``y`` in {0, 1} by log-loss boosting."""
    cuts = []
    for column in x.T:
        values = np.unique(column)
        cuts.append((values[:-1] + values[1:]) / 2 if len(values) <= BINS
                    else np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])))
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Trees(*(np.zeros((0, 1)),) * 3, base=float(np.log(share / (1 - share))))
    score, made = np.full(len(x), model.base), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        feature, limit, leaf = _tree(x, y - p, p * (1 - p), cuts)
        made.append((feature, limit, rate * leaf))
        score = score + Trees(feature[None], limit[None], rate * leaf[None], 0.0).score(x)
    model.feature, model.limit, model.leaf = (np.array(part) for part in zip(*made))
    return model


def calibrate(model: Trees, x: np.ndarray, y: np.ndarray, steps: int = 500) -> None:
    """Platt scaling on held-out rows, with smoothed targets."""
    score = model.score(x)
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(model.scale * score + model.shift))) - goal
        spread = score.std() + 1e-9
        model.scale -= 0.5 * float((error * score).mean()) / spread ** 2
        model.shift -= 0.5 * float(error.mean())


def threshold(probability: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least probability at which held-out precision reaches ``precision``
    (above 1 if none does)."""
    order = np.argsort(-probability, kind="stable")
    hits = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
    last_of_tie = np.append(probability[order][1:] != probability[order][:-1], True)
    good = np.flatnonzero((hits >= precision) & last_of_tie)
    return float(probability[order][good[-1]]) if len(good) else 2.0
