"""Target-distribution importance resampling: array-scored weights, ranks by a distributed radix sort.

Words and word pairs of a text fall into hashed buckets. One pass counts the
buckets of the raw texts, another those of the target; the gain of a bucket is
the scaled log ratio of the two smoothed models. A text's weight is the mean
gain of its features, looked up in one array. With Gumbel noise that depends on
the id alone, the highest scores are a sample without replacement; their ranks
come from ``radix_places``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.arrays import LOWER, flat, pieces
from vigilseries.llm.radix import radix_places
from vigilseries.llm.scratch import drop, store

BUCKETS = 10_000
TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    TABLE = np.where(TABLE & 1, np.uint32(0xEDB88320) ^ (TABLE >> 1), TABLE >> 1).astype(np.uint32)
#: Bytes of words once A-Z are lowered: 0-9, a-z and all beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LONG_WORD = 48
PACKED_BITS = 62


def word_spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, starts and ends of all words, and the first word of each text."""
    data, offsets = flat(column)
    data = LOWER[data]
    # One byte that is no word between texts keeps their words apart.
    gaps = offsets[1:-1]
    inside = np.insert(WORD[data], gaps, False) if len(gaps) else WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    place = offsets[:-1] + np.arange(len(offsets) - 1)
    first = np.append(np.searchsorted(starts, place), len(starts))
    shift = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return data, starts - shift, ends - shift, first


def _extend(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 registers after the bytes of each range: one byte of all ranges at a time, the longest ranges first."""
    size = ends - starts
    order = np.argsort(np.minimum(size, LONG_WORD + 1).astype(np.uint8), kind="stable")[::-1]
    size, begin, out = size[order], starts[order], state[order]
    far = int(np.count_nonzero(size > LONG_WORD))
    for k in range(far):
        out[k] = zlib.crc32(data[begin[k]: begin[k] + size[k]].tobytes(), int(out[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    size, begin, short = size[far:], begin[far:], out[far:]
    more = np.concatenate([[0], np.cumsum(np.bincount(size, minlength=1))])
    for k in range(int(size[0]) if len(size) else 0):
        n = len(size) - int(more[k + 1])
        register = short[:n]
        short[:n] = TABLE[(register ^ data[begin[:n] + k]) & 0xFF] ^ (register >> 8)
    back = np.empty_like(out)
    back[order] = out
    return back


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and text and bucket of every word and every pair of neighbours (repeats included)."""
    data, starts, ends, first = word_spans(column)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    one = _extend(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, ends)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    left = one[pair]
    spaced = TABLE[(left ^ 0x20) & 0xFF] ^ (left >> 8)
    two = _extend(spaced, data, starts[pair + 1], ends[pair + 1])
    bucket = (~np.concatenate([one, two])) % np.uint32(BUCKETS)
    return np.diff(first), np.concatenate([owner, owner[pair]]), bucket.astype(np.int64)


def bucket_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features of all texts per bucket. One row per task and used bucket is shuffled, ``BUCKETS`` reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for texts in pieces(batch.column(0), 1 << 20):
                total += np.bincount(features(texts)[2], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])
    out = np.zeros(BUCKETS, np.int64)
    for r in docs.select(text_col).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's ratio of the smoothed target and raw models."""
    s_all, t_all = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(raw, target, strict=True)], np.int64)


def target_weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, n_words, n_features, weight)`` per row; ``key`` is the text's hash, ``weight`` the floored mean gain (none: 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(2), 1 << 20):
                words, owner, bucket = features(texts)
                many = np.maximum(2 * words - 1, 0)
                # Whole numbers far below 2**53: sums of doubles are exact.
                total = np.bincount(owner, table[bucket], minlength=len(texts)).astype(np.int64)
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, (words, many, total // np.maximum(many, 1)))],
                                                 ["id", "key", "n_words", "n_features", "weight"])
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("key"), text_col)
    return rows.mapInArrow(run, "id bigint, key bigint, n_words bigint, n_features bigint, weight bigint")


def noise(id_col: str, seed: int) -> Column:
    """floor(1000 * Gumbel) of the first 32 bits of sha256('seed:id'); a null id counts as no characters."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, id_col: str = "doc_id",
             text_col: str = "text", target_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_features``, ``weight``, ``score``, ``rank``, and ``key``, the text's hash.

    ``percent`` of the texts with ``least_words`` words are drawn: the highest
    scores, ties to the smaller id (null last), ranked from 1; other rows have a
    null rank. Null and empty texts have no features, weight 0 and are never
    drawn. Rows that repeat an id and a text score alike and are ranked one after
    the other. Empty tables give no rows or, as a target, an even model. No other
    column is read.
    """
    raw, wanted = (bucket_counts(d, c) for d, c in ((docs, text_col), (target, target_col)))
    weighed = target_weights(docs, gains(raw, wanted), id_col, text_col)
    scored = store(weighed.withColumn("score", F.col("weight") + noise("id", seed)), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    names = ["id", "n_features", "weight", "score", "key"]
    n, top, low, first, last, blank = able.agg(F.count(F.lit(1)), F.max("score"), F.min("score"), F.min("id"), F.max("id"),
                                               F.count(F.when(F.col("id").isNull(), 1))).first()
    out = scored.where(F.col("n_words") < least_words).select(*names, F.lit(None).cast("bigint").alias("rank"))
    if n:
        sorted_rows = radix_places(able.select(*names), _keys(top, low, first, last, blank))
        rank = F.when(F.col("place") < n * percent // 100, F.col("place") + 1)
        out = out.unionByName(sorted_rows.select(*names, rank.alias("rank")))
    return out.withColumnRenamed("id", id_col)


def _keys(top: int, low: int, first: int | None, last: int | None, blank: int) -> list[tuple[Column, int]]:
    """Falling score, then rising id with nulls last, as unsigned numbers; in one where the bits allow."""
    falling, high = F.lit(top) - F.col("score"), max(1, (top - low).bit_length())
    if first is None:
        return [(falling, high)]
    reach = last - first + 1  # a null id takes the place after the last
    if high + reach.bit_length() <= PACKED_BITS:
        rising = F.coalesce(F.col("id") - F.lit(first), F.lit(reach))
        return [(F.shiftleft(falling, reach.bit_length()).bitwiseOR(rising), high + reach.bit_length())]
    signed = F.coalesce(F.col("id"), F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))
    return [(falling, high), *([(F.col("id").isNull().cast("bigint"), 1)] if blank else []), (signed, 64)]


def drawn_documents(docs: DataFrame, ranked: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``resample`` drew, with all their columns. Rows without an id are not looked up."""
    chosen = ranked.where("rank IS NOT NULL").select(F.col(id_col).alias("_id"), F.col("key").alias("_key")).distinct()
    return docs.join(chosen, (docs[id_col] == F.col("_id")) & (F.xxhash64(docs[text_col]) == F.col("_key")), "left_semi")
