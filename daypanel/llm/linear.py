"""Small linear models over sparse indicator features, fitted on a bounded sample."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows of indicators: the features of row k are ``index[start[k]:start[k + 1]]``."""

    def __init__(self, features: list[np.ndarray]):
        self.start = np.concatenate(([0], np.cumsum([len(f) for f in features]))).astype(np.int64)
        self.index = np.concatenate([*features, np.empty(0, np.int64)]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.start) - 1

    def of(self, k: int) -> np.ndarray:
        return self.index[self.start[k] : self.start[k + 1]]

    def take(self, rows: np.ndarray) -> "Rows":
        return Rows([self.of(k) for k in rows])

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(w[self.index])))
        return sums[self.start[1:]] - sums[self.start[:-1]]

    def add(self, values: np.ndarray, dim: int) -> np.ndarray:
        """Per feature, the sum of the values of the rows that have it."""
        return np.bincount(self.index, weights=np.repeat(values, np.diff(self.start)), minlength=dim)


def log_count_ratio(x: Rows, y: np.ndarray, dim: int, smooth: float = 1.0) -> np.ndarray:
    """Naive Bayes weights: the log ratio of each feature's share in the positive and the negative rows."""
    p, q = smooth + x.add(y.astype(float), dim), smooth + x.add(1.0 - y, dim)
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(x: Rows, y: np.ndarray, scale: np.ndarray, cost: np.ndarray, epochs: int = 20, tolerance: float = 1e-3, seed: int = 4) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model by dual coordinate descent; returns weights and bias.

    Minimises ``|w|^2 / 2 + sum(cost * max(0, 1 - s (w x + b)))`` with ``s`` = -1 or 1 and ``x`` the indicators times ``scale``. Rows
    are visited in a drawn order; an epoch in which no projected gradient exceeds the tolerance ends the fit.
    """
    sign = np.where(y > 0, 1.0, -1.0)
    w, b, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(x))
    rows = [(f, scale[f]) for f in map(x.of, range(len(x)))]
    norm = [float(v @ v) + 1.0 for _, v in rows]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for k in rng.permutation(len(x)):
            f, v = rows[k]
            gradient = sign[k] * (float(w[f] @ v) + b) - 1.0
            old = alpha[k]
            projected = min(gradient, 0.0) if old <= 0 else max(gradient, 0.0) if old >= cost[k] else gradient
            if projected:
                worst = max(worst, abs(projected))
                alpha[k] = min(max(old - gradient / norm[k], 0.0), cost[k])
                step = (alpha[k] - old) * sign[k]
                w[f] += step * v
                b += step
        if worst < tolerance:
            break
    return w, b


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset of a sigmoid over margins, by Newton steps on smoothed targets."""
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * margin + b)
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        ga, gb = float(d @ margin), float(d.sum())
        haa, hab, hbb = float(h @ (margin * margin)) + 1e-6, float(h @ margin), float(h.sum()) + 1e-6
        det = haa * hbb - hab * hab
        sa, sb = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 5.0 / max(abs(sa), abs(sb), 1e-12))
        a, b = a - step * sa, b - step * sb
        if max(abs(sa), abs(sb)) < 1e-8:
            break
    return a, b
