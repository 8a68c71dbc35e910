"""Non-negative positive-unlabelled learning in numpy.

With class prior ``p``, positives P and unlabelled rows U, the risk is
``p * E_P[l(g)] + max(0, E_U[l(-g)] - p * E_P[l(-g)])`` for the logistic loss l:
the share of positives among U is taken out of the negative part, which is not
allowed below zero. Where it falls below zero, a step goes up its own gradient.
"""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


def risk_gradient(g: np.ndarray, positive: np.ndarray, prior: float) -> np.ndarray:
    """d risk / d g for rows marked positive or (else) unlabelled."""
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    up = np.where(positive, prior / n_p, 0.0)
    down = np.where(positive, -prior / n_p, 1.0 / n_u)
    loss_down = np.logaddexp(0, g)
    grad_down = down * sigmoid(g)
    if float((down * loss_down).sum()) < 0:
        return -grad_down
    return -up * sigmoid(-g) + grad_down


def match_prior(g: np.ndarray, prior: float, start: float) -> float:
    """The bias at which unlabelled rows are positive, on average, as often as the prior says.

    Past the point where the risk is clipped nothing holds the bias down.
    """
    lo, hi = start - 30.0, start + 30.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sigmoid(g + mid).mean() < prior else (lo, mid)
    return (lo + hi) / 2


class Adam:
    def __init__(self, *params: np.ndarray, rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = [np.zeros_like(p) for p in params]
        self.v = [np.zeros_like(p) for p in params]

    def step(self, *grads: np.ndarray) -> None:
        self.t += 1
        for p, g, m, v in zip(self.params, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= self.rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


def _logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return float(np.log(p / (1 - p)))


def fit_sparse(row: np.ndarray, col: np.ndarray, n_cols: int, positive: np.ndarray, prior: float,
               steps: int = 800, decay: float = 2e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear score over present features (row i has column j)."""
    w, b = np.zeros(n_cols), np.array([_logit(prior * 0.2)])
    adam = Adam(w, b, rate=0.05)
    mean_w, mean_b = np.zeros(n_cols), 0.0
    for step in range(steps):
        if step >= steps // 2:  # the mean of the later steps: single ones may climb where the risk is clipped
            mean_w += w / (steps - steps // 2)
            mean_b += float(b[0]) / (steps - steps // 2)
        g = b[0] + np.bincount(row, weights=w[col], minlength=len(positive))
        d = risk_gradient(g, positive, prior)
        adam.step(np.bincount(col, weights=d[row], minlength=n_cols) + decay * w, np.array([d.sum()]))
    g = np.bincount(row, weights=mean_w[col], minlength=len(positive))[~positive]
    return mean_w, match_prior(g, prior, mean_b)


def fit_dense(x: np.ndarray, positive: np.ndarray, prior: float, hidden: int = 24, steps: int = 300,
              decay: float = 1e-4, seed: int = 5) -> list[np.ndarray]:
    """A network with one hidden layer over standardised columns."""
    x = x.astype(np.float32)
    rng = np.random.Generator(np.random.PCG64(seed))
    a = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)).astype(np.float32)
    c, w = np.zeros(hidden, np.float32), rng.normal(0, 0.1, hidden).astype(np.float32)
    b = np.array([_logit(prior)], np.float32)
    adam = Adam(a, c, w, b, rate=0.02)
    for _ in range(steps):
        h = np.tanh(x @ a + c)
        d = risk_gradient(h @ w + b[0], positive, prior).astype(np.float32)
        back = np.outer(d, w) * (1 - h * h)
        adam.step(x.T @ back + decay * a, back.sum(axis=0), h.T @ d + decay * w, np.array([d.sum()]))
    return [a, c, w, b]


def score_dense(model: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    a, c, w, b = model
    return sigmoid(np.tanh(x @ a + c) @ w + b[0])
