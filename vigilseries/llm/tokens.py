"""Byte-level BPE token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.arrays import cuts, flat, ragged, spans_hash

OTHER, LETTER, NUMBER, BLANK = range(4)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
CACHE = 1 << 19
LONG = np.int64(1) << np.int64(40)


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        found = "".join(regex.findall(f"{pattern}+", every))
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Merge ranks of a byte-level BPE file as sorted arrays."""

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right, out = (np.array([vocab[f(p)] for p in pairs], np.int64) for f in (lambda p: p[0], lambda p: p[1], "".join))
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), out[order]
        self.of_byte = np.zeros(256, np.int64)
        for symbol, byte in byte_symbols().items():
            self.of_byte[byte] = vocab[symbol]
        self.special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Symbols left of each byte range once no pair of neighbours has a rank.

        Every round merges, in each range, all places of its lowest-ranked pair;
        of overlapping places the left one wins.
        """
        sizes = ends - starts
        first = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(starts)), sizes)
        symbols = self.of_byte[data[np.arange(first[-1]) + np.repeat(starts - first[:-1], sizes)]]
        left_over = np.zeros(len(starts), np.int64)
        while len(symbols):
            joined = owner[1:] == owner[:-1]
            key = np.where(joined, symbols[:-1] << 32 | symbols[1:], -1)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.rank[at], LONG)
            rank = np.append(rank, LONG)
            first = np.flatnonzero(np.append(True, ~joined))
            best = np.minimum.reduceat(rank, first)
            ids, size = owner[first], np.diff(np.append(first, len(symbols)))
            done = best == LONG
            left_over[ids[done]] = size[done]
            low = np.repeat(best, size)
            hit = (rank == low) & (low < LONG)
            # A run of hits one after another (as in "aaaa") takes every second one.
            index = np.arange(len(hit))
            run = index - np.maximum.accumulate(np.where(hit, 0, index + 1))
            take = hit & (run % 2 == 0)
            symbols[take] = self.made[np.append(at, 0)[take]]
            keep = np.repeat(~done, size)
            keep[1:] &= ~take[:-1]
            symbols, owner = symbols[keep], owner[keep]
        return left_over


@lru_cache(maxsize=2)
def _merges(text: str) -> Merges:
    return Merges(text)


def pretokens(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens in code points of texts that begin at ``first[:-1]``.

    Runs of letters, numbers or other signs take one space before them; the last
    blank of a run stands alone unless it is that space; an apostrophe that
    begins a run takes the rest of an English contraction.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[codes]
    edge = np.zeros(n + 1, bool)
    edge[first[first <= n]] = True
    edge[n] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    before_text = np.zeros(n, bool)  # blanks with something else right after them in the same text
    before_text[:-1] = (kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~edge[1:n]
    start |= before_text
    space = before_text & (codes == 32)
    start[1:] &= ~space[:-1]
    for at in np.flatnonzero((codes == 39) & start):
        stop = at + 4
        tail = codes[at + 1: stop]
        for word in CONTRACTIONS:
            k = len(word)
            if len(tail) >= k and not edge[at + 1: at + 1 + k].any() and "".join(map(chr, tail[:k])) == word:
                start[at + 1: at + 1 + k] = False
                start[at + 1 + k: at + 2 + k] = True
                break
    return np.flatnonzero(start)


def count_tokens(docs: DataFrame, tokenizer_json: str, text_col: str = "text", id_col: str = "doc_id",
                 limit: int = 1024) -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``tokenizer_json`` is the content of a byte-level BPE tokenizer file; strings
    of its added tokens count as one token each. A null text counts as empty (0
    bytes, 0 tokens). Every input row gives one row, also with repeated or null
    ids. Whole texts are counted; nothing is shuffled. Pre-tokens of a batch are
    counted once each, and up to ``CACHE`` counts are kept between batches.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, cache = _merges(shared.value), {}
        for batch in batches:
            for lo, hi in cuts(batch.column(1), 1 << 20):
                part = batch.slice(lo, hi - lo)
                yield pa.record_batch([part.column(0), *_counted(part.column(1), merges, cache, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)


def _counted(column: pa.Array, merges: Merges, cache: dict, limit: int) -> list[pa.Array]:
    data, offsets = flat(column)
    text = data.tobytes().decode()
    n_bytes = np.diff(offsets)
    special = np.zeros(len(n_bytes), np.int64)
    starts_of_texts = offsets
    if any(s in text for s in merges.special):
        # Added tokens cut the text: what stands between them is split on its own.
        pattern = regex.compile("|".join(map(regex.escape, merges.special)))
        cut = [(m.start(), m.end()) for m in pattern.finditer(text)]
        at_char = np.array(cut)
        widths = _widths(text)
        spans = np.concatenate([[0], np.cumsum(widths)])[at_char]
        owner = np.searchsorted(offsets, spans[:, 0], side="right") - 1
        inside = spans[:, 1] <= offsets[owner + 1]
        np.add.at(special, owner[inside], 1)
        keep = np.ones(len(data), bool)
        for lo, hi in spans[inside]:
            keep[lo:hi] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        starts_of_texts = np.unique(np.concatenate([kept[offsets], kept[spans[inside, 0]]]))
        data, offsets = data[keep], kept[offsets]
        text = data.tobytes().decode()
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    place = np.concatenate([[0], np.cumsum(_widths(text))])
    if len(place) == len(data) + 1:
        first = starts_of_texts
    else:
        first = np.searchsorted(place, starts_of_texts)
    begins = place[pretokens(codes, first)]
    ends = np.append(begins[1:], len(data)).astype(np.int64)
    key = spans_hash(data, begins, ends) if len(begins) else np.zeros(0, np.uint64)
    unique, where, back = np.unique(key, return_index=True, return_inverse=True)
    counts = np.array([cache.get(k, -1) for k in unique.tolist()], np.int64)
    new = np.flatnonzero(counts < 0)
    counts[new] = merges.counts(data, begins[where[new]], ends[where[new]])
    if len(cache) + len(new) > CACHE:
        cache.clear()
    cache.update(zip(unique[new].tolist(), counts[new].tolist(), strict=True))
    tokens = ragged(np.add, counts[back], np.searchsorted(begins, offsets), 0) + special
    return [pa.array(n_bytes), pa.array(tokens), pa.array(tokens > limit)]


def _widths(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
