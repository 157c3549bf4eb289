"""Texts of Arrow columns as flat numpy arrays: words, word hashes and ragged reductions.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. Every text is
worked through in pieces of about ``STEP`` bytes cut at white space, so memory
follows the number of words, not eight bytes for every byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

STEP = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and their inverses modulo 2**64."""
    if len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range ``[start, end)`` of ``data``."""
    up, down = powers(max(len(data), 1))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.multiply(_VALUE[data], up[: len(data)], out=sums[1:])
    np.cumsum(sums, out=sums)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Words of several texts: text ``i`` owns words ``first[i]:first[i + 1]``."""

    first: np.ndarray
    hashes: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end and the offsets of each; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]: offsets[-1]] if raw is not None and len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def pieces(column: pa.Array, limit: int = 4 * STEP) -> Iterator[pa.Array]:
    """Runs of rows whose texts hold at most ``limit`` bytes together; a longer text comes alone."""
    for lo, hi in cuts(column, limit):
        yield column.slice(lo, hi - lo)


def cuts(column: pa.Array, limit: int = 4 * STEP) -> Iterator[tuple[int, int]]:
    _, offsets = flat(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def words(column: pa.Array, lower: bool = False, hashed: bool = True) -> Words:
    data, offsets = flat(column)
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    cut = offsets[1:] - 1
    after[cut[cut >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    return Words(first, _hash_words(data, starts, ends) if hashed else np.zeros(0, np.uint64), data, starts, ends)


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + STEP, side="right")))
        at = starts[lo]
        out[lo:hi] = spans_hash(data[at: ends[hi - 1]], starts[lo:hi] - at, ends[lo:hi] - at)
        lo = hi
    return out


def grams(hashes: np.ndarray, first: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``n`` words, and their offsets.

    With ``short`` a text of 1 to n-1 words gives its whole sequence as one.
    """
    counts = np.diff(first)
    many = np.maximum(counts - n + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(many)])
    at = np.arange(offsets[-1]) + np.repeat(first[:-1] - offsets[:-1], many)
    code = np.full(len(at), n, np.uint64)
    for k in range(n):
        code = mix(code * np.uint64(_BASE) + hashes[at + k])
    if not short or not ((counts > 0) & (counts < n)).any():
        return code, offsets
    few = np.flatnonzero((counts > 0) & (counts < n))
    whole = np.array([_sequence(hashes[first[i]: first[i + 1]]) for i in few], np.uint64)
    return np.insert(code, offsets[few], whole), offsets + np.concatenate([[0], np.cumsum((counts > 0) & (counts < n))])


def _sequence(hashes: np.ndarray) -> np.uint64:
    code = np.full(1, len(hashes), np.uint64)
    for h in hashes:
        code = mix(code * np.uint64(_BASE) + h)
    return code[0]


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and without repeats, and their offsets."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.searchsorted(owner[new], np.arange(len(first)))


def ragged(ufunc, values: np.ndarray, first: np.ndarray, empty) -> np.ndarray:
    """Reduce each text's values with ``ufunc``; ``empty`` where there are none."""
    out = np.full((len(first) - 1, *values.shape[1:]), empty, values.dtype)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        out[full] = ufunc.reduceat(values, first[:-1][full], axis=0)
    return out


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and offsets."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))
