"""A compressed full-text index over integer symbols: Burrows-Wheeler transform and wavelet matrix.

Built per shard in numpy. All searches run for many patterns at once.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order, compared up to ``depth`` symbols or more (prefix doubling)."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    order, k = np.argsort(rank, kind="stable"), 1
    while k < depth:
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:]
        pair = rank << 32 | second
        order = np.argsort(pair, kind="stable")
        sorted_ = pair[order]
        new = np.append(True, sorted_[1:] != sorted_[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        k *= 2
        if new.all():
            break
    return order


class Bits:
    """A bit vector with constant-time rank: 64-bit words and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bool)), bitorder="little")
        self.words = packed.view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(ones) - ones).astype(np.int32 if len(bits) < 1 << 31 else np.int64)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """How many ones stand before position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class FMIndex:
    """Backward search over a text of symbols 0 .. n-1; positions come from the suffix order."""

    def __init__(self, text: np.ndarray, depth: int):
        self.order = suffix_order(text, depth)
        last = text[self.order - 1]  # the transform: the symbol before each suffix, cyclically
        size = int(text.max()) + 1
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))
        self.levels, self.zeros = [], []
        now = last
        for b in range(max(1, (size - 1).bit_length()) - 1, -1, -1):
            bit = (now >> b) & 1 == 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))
        self.runs = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Follow positions of the transform down the levels along their symbols."""
        top = len(self.levels) - 1
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbol >> (top - k)) & 1 == 1
            r = bits.rank(at)
            at = np.where(one, zeros + r, at - r)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + pattern, from the intervals [low, high) of each pattern."""
        n = len(symbol)
        at = self._down(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        # At the bottom a symbol's positions form one run; runs[symbol] is where it starts.
        start = self.before[symbol] - self.runs[symbol]
        return start + at[:n], start + at[n:]


def shared_prefix(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix in order, whether its first ``depth`` symbols are those of the suffix before it."""
    n = len(text)
    padded = np.append(text, np.full(depth, -1, text.dtype))
    same = np.zeros(n, bool)
    a, b = order[:-1], order[1:]
    live = np.arange(n - 1)
    for k in range(depth):
        live = live[padded[a[live] + k] == padded[b[live] + k]]
        if not len(live):
            break
    same[live + 1] = True
    return same
