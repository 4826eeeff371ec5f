"""A linear-chain conditional random field in NumPy.

Emission scores are sums of hashed feature weights, transitions are learned
with them by maximum likelihood (forward-backward, Adam over the whole sample).
Sequences of different length are worked on together, one step of time for all
of them at once; memory follows the number of positions, without padding.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Bag:
    """Feature buckets of items, item after item; starts: where each begins.

    Every item has one bucket at least. The bucket -1 counts as no feature.
    """

    buckets: np.ndarray
    starts: np.ndarray

    def item_of(self) -> np.ndarray:
        counts = np.diff(np.append(self.starts, len(self.buckets)))
        return np.repeat(np.arange(len(self.starts)), counts)


class _TimeMajor:
    """Positions of ragged sequences in order of time, longest sequence first."""

    def __init__(self, lens: np.ndarray):
        order = np.argsort(-lens, kind="stable")
        rank = np.empty(len(lens), np.int64)
        rank[order] = np.arange(len(lens))
        t = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
        self.active = np.bincount(t, minlength=1)
        self.off = np.concatenate([[0], np.cumsum(self.active)])
        self.place = self.off[t] + np.repeat(rank, lens)  # of each position

    def blocks(self):
        return zip(self.off[:-1].tolist(), self.off[1:].tolist())


@dataclass
class Chain:
    labels: list[str]
    weights: np.ndarray  # (features + 1, labels); the last row stays zero
    trans: np.ndarray
    start: np.ndarray

    @classmethod
    def new(cls, labels: list[str], features: int) -> Chain:
        k = len(labels)
        return cls(labels, np.zeros((features + 1, k), np.float32), np.zeros((k, k)), np.zeros(k))

    def emissions(self, bags: list[Bag]) -> np.ndarray:
        return sum(np.add.reduceat(self.weights[b.buckets], b.starts, axis=0) for b in bags)

    def marginals(self, emission: np.ndarray, lens: np.ndarray, pairs: bool = False):
        """Posterior of each label at each position (sequence after sequence);
        with pairs also the expected transitions. No sequence may be empty."""
        tm = _TimeMajor(lens)
        e = np.empty_like(emission)
        e[tm.place] = np.exp(emission - emission.max(axis=1, keepdims=True))
        t = np.exp(self.trans).astype(e.dtype)
        a = np.empty_like(e)
        last = None
        for lo, hi in tm.blocks():
            x = e[lo:hi] * np.exp(self.start).astype(e.dtype) if last is None else (last[: hi - lo] @ t) * e[lo:hi]
            a[lo:hi] = last = x / x.sum(axis=1, keepdims=True)
        expected = np.zeros_like(self.trans)
        b = np.ones_like(e[:0])
        prev = None
        for lo, hi in reversed(list(tm.blocks())):
            if prev is not None:
                ahead = e[prev[0] : prev[1]] * b
                if pairs:
                    xi = a[lo : lo + len(b), :, None] * t * ahead[:, None, :]
                    expected += (xi / xi.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b = ahead @ t.T
                b /= b.sum(axis=1, keepdims=True)
            b = np.concatenate([b, np.ones((hi - lo - len(b), e.shape[1]), e.dtype)])
            prev = (lo, hi)
            a[lo:hi] *= b
            a[lo:hi] /= a[lo:hi].sum(axis=1, keepdims=True)
        return (a[tm.place], expected) if pairs else a[tm.place]

    def viterbi(self, emission: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """The best labels' indices at each position."""
        tm = _TimeMajor(lens)
        e = np.empty_like(emission)
        e[tm.place] = emission
        back = np.zeros(e.shape, np.int16)
        best, ends = None, np.zeros(len(e), np.int64)
        for lo, hi in tm.blocks():
            if best is None:
                best = e[lo:hi] + self.start
            else:
                through = best[: hi - lo, :, None] + self.trans[None]
                back[lo:hi] = through.argmax(axis=1)
                best = through.max(axis=1) + e[lo:hi]
            ends[lo:hi] = best.argmax(axis=1)
        out, ahead = ends.copy(), None
        for lo, hi in reversed(list(tm.blocks())):
            if ahead is not None:  # sequences that go on take what the next step came from
                out[lo : lo + ahead[1] - ahead[0]] = back[ahead[0] : ahead[1]][np.arange(ahead[1] - ahead[0]), out[ahead[0] : ahead[1]]]
            ahead = (lo, hi)
        return out[tm.place]

    def fit(self, bags: list[Bag], items: np.ndarray, gold: np.ndarray, lens: np.ndarray, rounds: int = 40, rate: float = 0.1, decay: float = 1e-4) -> Chain:
        """items: the item at each position; gold: the label's index there."""
        n, k = len(items), len(self.labels)
        users = [b.item_of() for b in bags]
        first = np.cumsum(lens) - lens
        inner = np.ones(n, bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        seen = np.zeros((k, k))
        np.add.at(seen, (gold[at - 1], gold[at]), 1)
        begun = np.bincount(gold[first], minlength=k)
        params = [self.weights, self.trans, self.start]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for step in range(1, rounds + 1):
            gamma, expected = self.marginals(self.emissions(bags)[items], lens, pairs=True)
            miss = gamma.astype(np.float64)
            miss[np.arange(n), gold] -= 1
            by_item = np.stack([np.bincount(items, miss[:, j], minlength=len(bags[0].starts)) for j in range(k)], axis=1) / n
            grad = np.zeros_like(self.weights)
            for b, own in zip(bags, users):
                slot = np.where(b.buckets < 0, len(grad) - 1, b.buckets)
                for j in range(k):
                    grad[:, j] += np.bincount(slot, by_item[own, j], minlength=len(grad))
            grad[-1] = 0
            for p, g, (m, v) in zip(params, [grad, (expected - seen) / n, (gamma[first].sum(axis=0) - begun) / n], moments):
                g = g + decay / n * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)).astype(p.dtype)
        self.weights[-1] = 0
        return self
