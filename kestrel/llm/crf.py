"""Linear-chain conditional random fields over sparse token features (numpy, small K).

Training maximises the regularised likelihood of labelled sequences by Adam with exact
forward-backward gradients. Decoding is forward-backward (posteriors) or Viterbi.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Model:
    labels: list
    weights: np.ndarray  # features x labels
    transitions: np.ndarray  # label x label
    start: np.ndarray


def feature_sums(table: np.ndarray, indices: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the table's rows for each token; ``counts`` features per token (may be 0)."""
    total = np.zeros((len(counts), table.shape[1]), table.dtype)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        for j in range(table.shape[1]):
            total[some, j] = np.add.reduceat(table[:, j][indices], starts)
    return total


def _normal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = a.sum(axis=-1, keepdims=True)
    return a / s, s


def forward_backward(emission: np.ndarray, valid: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Posteriors (s, l, k) and summed transition posteriors of padded sequences (scores, not logs)."""
    s, n, k = emission.shape
    e = np.exp(emission - emission.max(axis=2, keepdims=True))
    t, first = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    alpha = np.empty((n, s, k))
    scale = np.ones((n, s, 1))
    alpha[0], scale[0] = _normal(first * e[:, 0])
    for i in range(1, n):
        v = valid[:, i, None]
        a, z = _normal((alpha[i - 1] @ t) * e[:, i])
        alpha[i], scale[i] = np.where(v, a, alpha[i - 1]), np.where(v, z, 1)
    beta = np.ones((s, k))
    post, pairs = np.empty((s, n, k)), np.zeros((k, k))
    for i in range(n - 1, -1, -1):
        post[:, i] = _normal(alpha[i] * beta)[0]
        if i:
            v = valid[:, i, None]
            right = e[:, i] * beta / scale[i]
            pairs += t * ((alpha[i - 1] * v).T @ (right * v))
            beta = np.where(v, right @ t.T, beta)
    return post, pairs


def train(indices: np.ndarray, counts: np.ndarray, gold: np.ndarray, lengths: np.ndarray, labels: list,
          n_features: int, rounds: int = 60, rate: float = 0.2, l2: float = 1e-6) -> Model:
    """Fit weights, transitions and start scores; tokens of all sequences one after another.

    ``gold`` holds label numbers, -1 where a token's label is not used by the loss of its own
    position (its transitions are then left out too).
    """
    k, n = len(labels), len(gold)
    s, longest = len(lengths), int(lengths.max())
    valid = np.arange(longest)[None, :] < lengths[:, None]
    model = Model(labels, np.zeros((n_features, k), np.float32, order="F"), np.zeros((k, k)), np.zeros(k))
    known = gold >= 0
    one = np.zeros((n, k), np.float32)
    one[np.flatnonzero(known), gold[known]] = 1
    heads = np.cumsum(lengths) - lengths
    inner = np.ones(n, bool)
    inner[heads] = False
    at = np.flatnonzero(inner & known & np.roll(known, 1))
    pair_gold = np.zeros((k, k))
    np.add.at(pair_gold, (gold[at - 1], gold[at]), 1)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.weights, model.transitions, model.start)]
    for r in range(1, rounds + 1):
        padded = np.zeros((s, longest, k))
        padded[valid] = feature_sums(model.weights, indices, counts)
        post, pairs = forward_backward(padded, valid, model.transitions, model.start)
        error = (one - post[valid].astype(np.float32)) * known[:, None]
        rows = np.repeat(error, counts, axis=0)
        grad_w = np.stack([np.bincount(indices, rows[:, j], n_features) for j in range(k)], 1).astype(np.float32)
        grads = (grad_w / n - l2 * model.weights, (pair_gold - pairs) / n - 1e-4 * model.transitions,
                 error[heads].sum(axis=0) / s)
        for p, g, (m, v) in zip((model.weights, model.transitions, model.start), grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-8)
        rate *= 0.97
    return model


def viterbi(emission: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> list[int]:
    """Best label sequence of one sequence of log scores."""
    if not len(emission):
        return []
    best, back = start + emission[0], []
    for e in emission[1:]:
        scores = best[:, None] + transitions
        back.append(scores.argmax(axis=0))
        best = scores.max(axis=0) + e
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def mean_posteriors(emission: np.ndarray, lengths: np.ndarray, model: Model, width: int = 64) -> np.ndarray:
    """Mean posterior of each label over each sequence (rows of 0 for empty ones).

    Exact forward-backward of many sequences of any lengths at once: sequences are cut into
    segments of ``width`` tokens, the segments' transfer matrices are multiplied inside all
    segments together, messages then pass from segment to segment, and last along the tokens.
    """
    k = emission.shape[1]
    out = np.zeros((len(lengths), k))
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    n = lengths[full]
    segments = -(-n // width)
    first = np.cumsum(segments) - segments
    total = int(segments.sum())
    doc = np.repeat(np.arange(len(full)), segments)
    nth = np.arange(total) - first[doc]
    size = np.minimum(width, n[doc] - nth * width)
    e = np.ones((total, width, k), np.float32)
    valid = np.arange(width)[None, :] < size[:, None]
    e[valid] = np.exp(emission - emission.max(axis=1, keepdims=True))
    t = np.exp(model.transitions - model.transitions.max()).astype(np.float32)
    begin = np.exp(model.start - model.start.max()).astype(np.float32)
    head = nth == 0
    product = np.where(head[:, None, None], np.eye(k, dtype=np.float32), t) * e[:, 0, None, :]
    for i in range(1, width):
        stepped = (product @ t) * e[:, i, None, :]
        stepped /= stepped.sum(axis=(1, 2), keepdims=True)
        product = np.where(valid[:, i, None, None], stepped, product)
    into = np.empty((total, k), np.float32)
    onto = np.ones((total, k), np.float32)
    into[first] = begin
    for j in range(1, int(segments.max())):
        at = first[segments > j] + j
        into[at] = _normal(np.einsum("sk,skj->sj", into[at - 1], product[at - 1]))[0]
    for j in range(int(segments.max()) - 1, 0, -1):
        at = first[segments > j] + j
        onto[at - 1] = _normal(np.einsum("skj,sj->sk", product[at], onto[at]))[0]
    alpha = np.empty((width, total, k), np.float32)
    a = np.where(head[:, None], into, into @ t) * e[:, 0]
    alpha[0] = _normal(a)[0]
    for i in range(1, width):
        alpha[i] = np.where(valid[:, i, None], _normal((alpha[i - 1] @ t) * e[:, i])[0], alpha[i - 1])
    beta, sums = onto, np.zeros((total, k))
    for i in range(width - 1, -1, -1):
        sums += _normal(alpha[i] * beta)[0] * valid[:, i, None]
        if i:
            beta = np.where(valid[:, i, None], _normal((beta * e[:, i]) @ t.T)[0], beta)
    out[full] = np.add.reduceat(sums, first, axis=0) / n[:, None]
    return out
