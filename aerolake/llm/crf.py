"""A linear-chain conditional random field of two labels, for many short chains at once.

A chain is a text's lines, label 1 the good one. Chains are laid out padded, longest
first, and every step of a recursion handles all chains that are that long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Chain:
    """``emit`` (2, features) and ``move`` (2, 2): scores of a label at a line and of a pair of labels."""

    emit: np.ndarray
    move: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return features @ self.emit.T


class Layout:
    """Chains of given lengths packed as (step, chain), longest chain first."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1][self.order]
        top = int(self.lengths[0]) if len(lengths) else 0
        # Step t holds the chains longer than t, which are the first ones.
        alive = np.searchsorted(-self.lengths, -np.arange(top), side="left")
        self.rows = [starts[:k] + t for t, k in enumerate(alive)]


def _sum(scores: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp.reduce(scores, axis=axis)


def marginals(chain: Chain, scores: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of each label at each line, of each pair summed over all chains, and the
    log of all chains' norms."""
    n = len(scores)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    pairs, norm = np.zeros((2, 2)), 0.0
    for t, rows in enumerate(layout.rows):
        forward[rows] = scores[rows] if t == 0 else scores[rows] + _sum(
            forward[layout.rows[t - 1][:len(rows)], :, None] + chain.move, 1)
    for t in range(len(layout.rows) - 2, -1, -1):
        after = layout.rows[t + 1]
        here = layout.rows[t][:len(after)]
        backward[here] = _sum(chain.move + (scores[after] + backward[after])[:, None, :], 2)
    both = forward + backward
    total = _sum(both, 1)
    for t in range(1, len(layout.rows)):
        after = layout.rows[t]
        here = layout.rows[t - 1][:len(after)]
        pair = (forward[here][:, :, None] + chain.move
                + (scores[after] + backward[after])[:, None, :] - total[here][:, None, None])
        pairs += np.exp(pair).sum(0)
    if layout.rows:
        norm = float(total[layout.rows[0]].sum())
    return np.exp(both - total[:, None]), pairs, norm


def viterbi(chain: Chain, scores: np.ndarray, layout: Layout) -> np.ndarray:
    """The likeliest labels of every chain; of equally likely ones those with label 0."""
    best, came = scores.copy(), np.zeros((len(scores), 2), np.int8)
    for t in range(1, len(layout.rows)):
        rows = layout.rows[t]
        ways = best[layout.rows[t - 1][:len(rows)], :, None] + chain.move
        came[rows] = ways.argmax(1)
        best[rows] += ways.max(1)
    labels = best.argmax(1)  # right at each chain's last line
    for t in range(len(layout.rows) - 2, -1, -1):
        after = layout.rows[t + 1]
        labels[layout.rows[t][:len(after)]] = came[after, labels[after]]
    return labels


def fit(features: np.ndarray, lengths: np.ndarray, labels: np.ndarray,
        l2: float = 1e-3, rounds: int = 150) -> Chain:
    """The chain of highest penalised conditional likelihood of the lines' ``labels``.

    L-BFGS with a backtracking line search.
    """
    lengths = np.asarray(lengths)
    layout, n, d = Layout(lengths), max(len(lengths), 1), features.shape[1]
    one = np.eye(2)[labels]
    ends = np.cumsum(lengths)
    inner = np.ones(max(len(features) - 1, 0), bool)
    inner[ends[:-1] - 1] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[at], labels[at + 1]), 1)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        chain = Chain(x[:2 * d].reshape(2, d), x[2 * d:].reshape(2, 2))
        scores = chain.scores(features)
        p, pairs, norm = marginals(chain, scores, layout)
        value = norm - (scores * one).sum() - (seen * chain.move).sum()
        slope = np.concatenate([((p - one).T @ features).ravel(), (pairs - seen).ravel()])
        return value / n + l2 * (x @ x) / 2, slope / n + l2 * x

    x = np.zeros(2 * d + 4)
    value, slope = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, saved = slope.copy(), []
        for s, y in reversed(steps):
            a = (s @ way) / (s @ y)
            way -= a * y
            saved.append(a)
        if steps:
            s, y = steps[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(saved)):
            way += s * (a - (y @ way) / (s @ y))
        size = 1.0
        while size > 1e-8:
            new_value, new_slope = loss(x - size * way)
            if new_value <= value - 1e-4 * size * (way @ slope):
                break
            size /= 2
        else:
            break
        s, y = -size * way, new_slope - slope
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-8:]
        done = value - new_value < 1e-7
        x, value, slope = x + s, new_value, new_slope
        if done:
            break
    return Chain(x[:2 * d].reshape(2, d), x[2 * d:].reshape(2, 2))
