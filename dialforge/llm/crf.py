"""Linear-chain conditional random fields over small whole-number features, in
numpy: fitting on a table of segments, certain bounds that tell where an entity can
be at all, and Viterbi decoding of many stretches at once.

A token's score for a tag is the sum of one weight row for each of its features;
adjacent tags add a transition weight. Tag 0 is "outside"; what lies before and
after a text is outside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

OUT = 0
BARRED = -1e6


@dataclass
class Chain:
    weights: list[np.ndarray]       # of each feature: value, tag
    steps: np.ndarray               # tag, next tag; BARRED where not allowed

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        return sum(w[f] for w, f in zip(self.weights, features))


def fit(features: np.ndarray, tags: np.ndarray, used: np.ndarray, sizes: list[int], allowed: np.ndarray,
        rounds: int = 50, rate: float = 0.5, penalty: float = 2e-3) -> Chain:
    """Full-batch gradient ascent of the likelihood. ``features`` is (segment,
    place, feature), ``used`` masks padding at the end of segments, ``sizes`` are
    the numbers of values of the features, ``allowed`` (tag, next tag) says which
    transitions exist."""
    n_tags = len(allowed)
    weights = [np.zeros((n, n_tags)) for n in sizes]
    steps = np.zeros((n_tags, n_tags))
    sums = [np.full_like(w, 1e-2) for w in weights] + [np.full_like(steps, 1e-2)]
    at = [features[..., k][used] for k in range(len(sizes))]     # of the tokens that are there
    onehot = np.eye(n_tags)[tags[used]]
    pair = used[:, 1:] & used[:, :-1]
    seen = np.zeros((n_tags, n_tags))
    np.add.at(seen, (tags[:, :-1][pair], tags[:, 1:][pair]), 1)
    total, length = max(len(onehot), 1), tags.shape[1]
    e = np.ones((*tags.shape, n_tags))
    for _ in range(rounds):
        u = sum(w[i] for w, i in zip(weights, at))
        e[used] = np.exp(u - u.max(axis=-1, keepdims=True))
        step = np.exp(steps) * allowed
        ahead, back = np.empty_like(e), np.ones_like(e)
        ahead[:, 0] = e[:, 0] * (allowed[OUT] + 1e-12)
        ahead[:, 0] /= ahead[:, 0].sum(axis=-1, keepdims=True)
        for t in range(1, length):
            x = ahead[:, t - 1] @ step * e[:, t] + 1e-300
            ahead[:, t] = np.where(used[:, t, None], x / x.sum(axis=-1, keepdims=True), ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            x = (e[:, t + 1] * back[:, t + 1]) @ step.T + 1e-300
            back[:, t] = np.where(used[:, t + 1, None], x / x.sum(axis=-1, keepdims=True), 1.0)
        p = (ahead * back)[used]
        p /= p.sum(axis=-1, keepdims=True)
        before, after = ahead[:, :-1][pair], (e * back)[:, 1:][pair]
        z = ((before @ step) * after).sum(axis=-1, keepdims=True) + 1e-300
        miss = np.ascontiguousarray((onehot - p).T)
        grads = [np.stack([np.bincount(i, m, len(w)) for m in miss], axis=1) for w, i in zip(weights, at)]
        grads.append((seen - step * ((before / z).T @ after)) * allowed)
        for w, g, s in zip([*weights, steps], grads, sums):
            g = g / total * 1000 - penalty * w
            s += g * g
            w += rate * g / np.sqrt(s)
    return Chain(weights, np.where(allowed, steps, BARRED))


class Bounds:
    """Where entities can be, from the most that each feature can gain over
    "outside"."""

    def __init__(self, chain: Chain, caution: float = 0.0):
        self.gains = [np.delete(w, OUT, axis=1).max(axis=1) - w[:, OUT] for w in chain.weights]
        s, rest = chain.steps, [t for t in range(len(chain.steps)) if t != OUT]
        self.inner = float(s[np.ix_(rest, rest)].max() - s[OUT, OUT])
        self.ends = float(s[OUT, rest].max() + s[rest, OUT].max() - 2 * s[OUT, OUT]) - self.inner
        self.caution = caution

    def stretches(self, features, barred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end of the runs of tokens that the best tags can leave
        "outside" for. A run of tagged tokens gains at most the sum of its tokens'
        gains and what its two ends gain; with a sum below 0 all-outside is better.
        So a token is outside for certain if no run across it reaches 0: the
        largest sum over such runs is a later maximum of the running sum less an
        earlier minimum. ``features`` yields one array a feature; ``barred`` are
        tokens that take no tag."""
        gain = np.full(len(barred), self.inner - self.caution)
        for g, f in zip(self.gains, features):
            gain += g[f]
        gain[barred] = BARRED
        run = np.concatenate([[0.0], np.cumsum(gain)])
        least = np.minimum.accumulate(run)[:-1]
        most = np.maximum.accumulate(run[::-1])[::-1][1:]
        may = (most - least + self.ends > -1e-6) & ~barred
        edge = np.diff(np.concatenate([[False], may, [False]]).astype(np.int8))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def viterbi(u: np.ndarray, length: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best tags of stretches (rows of ``u``: stretch, place, tag) of the given
    lengths whose neighbours on both sides are outside."""
    n, longest, n_tags = u.shape
    best = steps[OUT] + u[:, 0]
    came = np.zeros((n, longest, n_tags), np.int8)
    for t in range(1, longest):
        through = best[:, :, None] + steps
        came[:, t] = through.argmax(axis=1)
        best = np.where((length > t)[:, None], through.max(axis=1) + u[:, t], best)
    tags = np.zeros((n, longest), np.int64)
    tag = (best + steps[:, OUT]).argmax(axis=1)
    rows = np.arange(n)
    for t in range(longest - 1, -1, -1):
        inside = length > t
        tags[inside, t] = tag[inside]
        tag = np.where(inside, came[rows, t, tag], tag)
    return tags


def decode(chain: Chain, first: np.ndarray, end: np.ndarray, features_at, caution: float = 0.0, cells: int = 1 << 16) -> list[np.ndarray]:
    """Tags of every stretch; ``features_at(places)`` gives the features of some
    tokens. Stretches of like length are decoded together, about ``cells`` tokens
    at a time."""
    out: list = [None] * len(first)
    size = end - first
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * size[order[stop]] <= cells:
            stop += 1
        take, at = order[at:stop], stop
        length = size[take]
        places = first[take][:, None] + np.arange(length.max())[None, :]
        inside = np.arange(length.max())[None, :] < length[:, None]
        u = np.zeros((*places.shape, len(chain.steps)))
        u[inside] = chain.scores(features_at(places[inside]))
        u[..., OUT] += caution
        tags = viterbi(u, length, chain.steps)
        for row, i in enumerate(take):
            out[i] = tags[row, :length[row]]
    return out
