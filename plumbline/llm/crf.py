"""A linear-chain conditional random field with two tags, in numpy.

Tokens have a few hashed features each; all chains of a batch are run through
forward-backward together, one step of time for all at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CLEAN, TOXIC = 0, 1


@dataclass(frozen=True)
class Crf:
    weights: np.ndarray  # features x tags
    start: np.ndarray  # tags
    step: np.ndarray  # tag before x tag

    def marginals(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(toxic) of each token; ``first`` are the bounds of the chains."""
        return forward_backward(self.weights[features].sum(axis=1), self.start, self.step, first)[0][:, TOXIC]


def forward_backward(emission: np.ndarray, start: np.ndarray, step: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Marginals (tokens x tags), with ``pairs`` also expected tag pairs (tag before x tag), and the summed log partition functions."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    begin, lengths = first[:-1][order], lengths[order]
    peak = emission.max(axis=1, keepdims=True)
    local, move = np.exp(emission - peak), np.exp(step)
    ahead, scale = np.empty_like(local), np.ones(len(local))
    longest = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(longest), side="left")  # chains longer than t come first
    for t in range(longest):
        at = begin[: running[t]] + t
        value = local[at] * (np.exp(start) if t == 0 else ahead[at - 1] @ move)
        scale[at] = value.sum(axis=1)
        ahead[at] = value / scale[at, None]
    behind = np.ones_like(local)
    expected = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = begin[: running[t + 1]] + t
        onward = local[at + 1] * behind[at + 1] / scale[at + 1, None]
        if pairs:
            expected += ahead[at].T @ onward * move
        behind[at] = onward @ move.T
    return ahead * behind, expected, float(np.log(scale).sum() + peak.sum())


def train(features: np.ndarray, first: np.ndarray, tags: np.ndarray, size: int, rounds: int = 40, decay: float = 1e-4, rate: float = 0.5) -> Crf:
    """Maximum likelihood with a little weight decay, by Adagrad on all chains at once."""
    weights, start, step = np.zeros((size, 2)), np.zeros(2), np.zeros((2, 2))
    begin = first[:-1][np.diff(first) > 0]
    inner = np.ones(len(tags), bool)
    inner[begin] = False
    after = np.flatnonzero(inner)
    seen = np.stack([np.bincount(features[tags == k].ravel(), minlength=size) for k in (0, 1)], axis=1).astype(float)
    seen_step = np.bincount(tags[after - 1] * 2 + tags[after], minlength=4).reshape(2, 2)
    seen_start = np.bincount(tags[begin], minlength=2)
    width = features.shape[1]
    moments = [np.full_like(x, 1e-6) for x in (weights, start, step)]
    for _ in range(rounds):
        p, pairs, _ = forward_backward(weights[features].sum(axis=1), start, step, first, pairs=True)
        share = np.stack([np.bincount(features.ravel(), weights=np.repeat(p[:, k], width), minlength=size) for k in (0, 1)], axis=1)
        slopes = [seen - share - decay * weights * len(tags) / size, seen_start - p[begin].sum(axis=0), seen_step - pairs]
        for value, slope, moment in zip((weights, start, step), slopes, moments):
            moment += slope**2
            value += rate * slope / np.sqrt(moment)
    return Crf(weights, start, step)
