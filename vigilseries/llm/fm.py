"""A compressed full-text index over word numbers: BWT in a wavelet matrix, backward search."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank: packed 64 to a word, a running count for each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)])[:-1].astype(np.int32)
        self.zeros = int(len(bits) - bits.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits among the first ``i``."""
        block = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class FMIndex:
    """Index of the sequence ``text`` of numbers 0..n for patterns of up to ``depth`` numbers.

    Suffixes are sorted by their first ``depth`` numbers, equal ones by place,
    which is enough for backward search of such patterns and puts the earliest
    occurrence first in every interval.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        while width < depth:
            step = min(width, depth - width)
            after = np.zeros(n, np.int64)
            after[: max(n - step, 0)] = rank[step:] + 1
            _, rank = np.unique(rank * (rank.max(initial=0) + 2) + after, return_inverse=True)
            width += step
        self.suffixes = np.argsort(rank, kind="stable").astype(np.int32)
        last = text[self.suffixes - 1]  # the number before each suffix; the first one's wraps to the end
        self.first = np.searchsorted(np.sort(text), np.arange(text.max(initial=0) + 2))
        self.levels, order = [], last
        for level in reversed(range(max(int(text.max(initial=0)).bit_length(), 1))):
            bit = (order >> level & 1).astype(bool)
            self.levels.append((level, Bits(bit)))
            order = np.concatenate([order[~bit], order[bit]])
        self.begin = np.zeros(len(self.first), np.int64)
        values, at = np.unique(order, return_index=True)
        self.begin[values] = at

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``i`` places of the BWT."""
        for level, bits in self.levels:
            ones = bits.ones(i)
            i = np.where(symbol >> level & 1, bits.zeros + ones, i - ones)
        return i - self.begin[symbol]

    def search(self, text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the patterns ``text[start:start + length]``, all searched at once, last number first."""
        symbol = text[starts + length - 1]
        lo, hi = self.first[symbol], self.first[symbol + 1]
        for k in range(length - 2, -1, -1):
            symbol = text[starts + k]
            both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
            base = self.first[symbol]
            lo, hi = base + both[: len(lo)], base + both[len(lo):]
        return lo, hi
