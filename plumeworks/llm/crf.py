"""A linear-chain conditional random field in numpy: training on a small table, Viterbi in padded batches.

A position has a fixed number of active features, given as rows of a weight table; score(label) is the sum of the
active rows plus a transition weight between neighbouring labels. Features are hashed, so any text can be scored.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np

#: Rows of the weight table. Hash collisions only blur two features.
TABLE = 1 << 14


def feature_rows(names: list[str]) -> list[int]:
    return [crc32(n.encode("utf-8", "surrogatepass")) % TABLE for n in names]


@dataclass(frozen=True)
class Crf:
    labels: tuple[str, ...]
    weights: np.ndarray  # TABLE x labels
    moves: np.ndarray  # from x to
    first: np.ndarray  # score of a label at the first position

    def emissions(self, rows: np.ndarray) -> np.ndarray:
        """Positions x features (rows of the table) -> positions x labels, added up feature by feature to hold no more than that."""
        out = np.zeros((*rows.shape[:-1], len(self.labels)))
        for k in range(rows.shape[-1]):
            out += self.weights[rows[..., k]]
        return out

    def reach(self, margins: np.ndarray, outside: int, most: int = 12) -> int | None:
        """How many quiet positions in a row always hold one that is outside on the best path; None if unproved.

        ``margins[y]``: the least by which outside beats label y at a quiet position. Also proves that between two
        outside positions with nothing but quiet ones in between, the best path stays outside. So a window that
        keeps twice as many quiet positions on each side is decoded as within the whole sequence.
        """
        other = np.array([k for k in range(len(self.labels)) if k != outside])
        stay = self.moves[outside, outside]
        inner = self.moves[np.ix_(other, other)] - margins[other][None, :]
        if inner.max() >= stay:
            return None
        away = self.moves[outside, other] - margins[other]
        for steps in range(1, 65):
            if (away + self.moves[other, outside]).max() >= stay * (steps + 1):
                return None
            away = (away[:, None] + inner).max(0)
        befores = np.vstack([self.moves, self.first[None, :]])
        afters = np.hstack([self.moves, np.zeros((len(self.labels), 1))])
        path = befores[:, other] - margins[other][None, :]
        for steps in range(1, most + 1):
            inside = (path[:, :, None] + afters[None, other, :]).max(1)
            through = befores[:, [outside]] + stay * (steps - 1) + afters[[outside], :]
            if (inside < through).all():
                return steps
            path = (path[:, :, None] + inner[None]).max(1)
        return None


def pad(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in sequences])
    out = np.zeros((len(sequences), lengths.max(), *sequences[0].shape[1:]), dtype=sequences[0].dtype)
    for i, s in enumerate(sequences):
        out[i, : len(s)] = s
    return out, lengths


def _viterbi(crf: Crf, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    n, steps, labels = scores.shape
    best = scores[:, 0] + crf.first
    back = np.zeros((n, steps, labels), dtype=np.int16)
    keep = np.arange(labels, dtype=np.int16)
    for t in range(1, steps):
        via = best[:, :, None] + crf.moves
        back[:, t] = via.argmax(1)
        on = (t < lengths)[:, None]
        back[:, t] = np.where(on, back[:, t], keep)
        best = np.where(on, via.max(1) + scores[:, t], best)
    path = np.zeros((n, steps), dtype=np.int16)
    path[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        path[:, t - 1] = back[np.arange(n), t, path[:, t]]
    return path


def decode(crf: Crf, sequences: list[np.ndarray], cells: int = 1 << 18) -> list[np.ndarray]:
    """The best label of every position of feature rows."""
    return decode_scores(crf, [crf.emissions(s) for s in sequences], cells)


def decode_scores(crf: Crf, sequences: list[np.ndarray], cells: int = 1 << 16) -> list[np.ndarray]:
    """The best label of every position of label scores. Sequences go in batches of similar length, ``cells`` padded positions
    each; a longer one goes alone."""
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int16)] * len(sequences)
    order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: len(sequences[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(sequences[order[end]]) <= cells:
            end += 1
        rows, lengths = pad([sequences[i] for i in order[at:end]])
        for i, path, size in zip(order[at:end], _viterbi(crf, rows, lengths), lengths):
            out[i] = path[:size]
        at = end
    return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(sequences: list[np.ndarray], targets: list[np.ndarray], labels: tuple[str, ...], rounds: int = 60, penalty: float = 0.02, rate: float = 0.15) -> Crf:
    """Maximum likelihood with an L2 penalty, by full-batch Adam steps. The result depends on nothing but the table."""
    rows, lengths = pad(sequences)
    gold, _ = pad([np.asarray(t, dtype=np.int64) for t in targets])
    n, steps, width = rows.shape
    size = len(labels)
    used, local = np.unique(rows, return_inverse=True)
    local = local.reshape(rows.shape)
    on = np.arange(steps)[None, :] < lengths[:, None]
    active = local[on].ravel()
    hot = np.eye(size)[gold] * on[:, :, None]
    pairs = on[:, 1:]
    gold_moves = np.zeros((size, size))
    np.add.at(gold_moves, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
    params = [np.zeros((len(used), size)), np.zeros((size, size)), np.zeros(size)]
    mean = [np.zeros_like(p) for p in params]
    var = [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        weights, moves, first = params
        scores = weights[local].sum(2)
        alpha = np.zeros((n, steps, size))
        beta = np.zeros((n, steps, size))
        alpha[:, 0] = scores[:, 0] + first
        for t in range(1, steps):
            nxt = _lse(alpha[:, t - 1, :, None] + moves, 1) + scores[:, t]
            alpha[:, t] = np.where(on[:, t, None], nxt, alpha[:, t - 1])
        total = _lse(alpha[:, -1], 1)
        for t in range(steps - 2, -1, -1):
            prev = _lse(moves + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(on[:, t + 1, None], prev, 0.0)
        marginal = np.exp(alpha + beta - total[:, None, None]) * on[:, :, None]
        wrong = hot - marginal
        spread = np.repeat(wrong[on], width, axis=0)
        slope = np.stack([np.bincount(active, spread[:, k], len(used)) for k in range(size)], axis=1)
        joint = np.exp(alpha[:, :-1, :, None] + moves + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None])
        move_slope = gold_moves - (joint * pairs[:, :, None, None]).sum((0, 1))
        slopes = [slope, move_slope, wrong[:, 0].sum(0)]
        for k, (p, g) in enumerate(zip(params, slopes)):
            g = g / n - penalty * p / np.sqrt(n)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            var[k] = 0.99 * var[k] + 0.01 * g * g
            params[k] = p + rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.99**step)) + 1e-8)
    table = np.zeros((TABLE, size))
    table[used] = params[0]
    return Crf(labels, table, params[1], params[2])
