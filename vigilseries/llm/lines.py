"""Fuzzy line deduplication: MinHash bands over character shingles, exact links, components.

A line is trimmed text between line feeds; blank lines are none. Lines that are
equal are one from the start. Every different line gets ``BANDS`` keys of
``ROWS`` MinHash values over its ``SHINGLE``-character shingles (a shorter line
is one shingle). The values come from one hash of each shingle: it falls into one
of ``BANDS * ROWS`` bins, the smallest in a bin is the value, and an empty bin
takes that of the next full one. Neighbours under one key are confirmed on the whole shingle
sets and joined to components; keys that still hold several components have all
their sets intersected. A link of similarity s is missed only if no band has it,
a chance of (1 - s**ROWS) ** BANDS: 2e-4 at 0.75, 1e-5 at 0.8, and no other path
joins its ends. The first line of a component stays, by id and line number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilseries.llm.arrays import flat, mix, pieces, powers
from vigilseries.llm.components import components
from vigilseries.llm.regions import across, confirm, small_semi
from vigilseries.llm.scratch import drop, store, unused

SHINGLE = 10
BANDS, ROWS = 16, 3
KEY_BITS = 48
#: Keys are shuffled packed, by their first bits; so many at once are packed by a task and looked at in sorted order.
BUCKET_BITS = 13
PACK, HELD = 1 << 19, 1 << 18
#: Bytes of lines hashed at once: what is made of them stays in a core's cache.
PIECE = 1 << 15
#: Scrambled code points of the usual scripts.
_CODES = mix(np.arange(1 << 12))


def line_components(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(line, component)`` for every line that is linked to a different one; lines are 64-bit hashes of their text."""
    each = _lines(docs, id_col, text_col).select("line", "text")
    packed = each.mapInArrow(_bander, "bucket int, pairs binary")
    # Different lines only; one key is streamed, never held.
    met = store(packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_neighbours, "key bigint, a bigint, b bigint"), "met")
    regions = met.select("key", F.explode(F.array("a", "b")).alias("id")).distinct()
    involved = store(regions.select("id").distinct(), "involved")
    # Texts are an eighth of their shingle sets, which each task derives anew.
    sets = store(small_semi(each.select(F.col("line").alias("id"), F.col("text").alias("shingles")), involved).dropDuplicates(["id"]), "texts")
    first = store(confirm(met.select("a", "b").distinct(), sets, percent, _sets), "links")
    grouped = components(first)
    # Of two lines under a key both were neighbours, so they are compared already.
    rest = store(across(regions.withColumnRenamed("key", "region"), sets, grouped, percent, _sets, 3), "links")
    # The components found before stand for their links.
    out = components(grouped.withColumnsRenamed({"node": "a", "component": "b"}).unionByName(rest))
    drop(met, involved, sets, first, rest, grouped)
    return out.withColumnRenamed("node", "line")


def dedup_lines(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row and column of ``docs``, the text without repeated lines, and ``n_lines``, ``n_dropped``.

    Lines left keep their order and are joined by line feeds; texts that lose
    nothing stay as they are. A null text stays null and has no lines. Rows with
    a null id are left alone and drop nothing elsewhere. Rows that repeat id and
    text count as one document. A document whose lines all go keeps its row with
    an empty text. A column of ``docs`` named ``n_lines`` or ``n_dropped`` is
    replaced; all others are kept whatever their names.
    """
    docs = docs.drop("n_lines", "n_dropped")
    id_, key, lost = unused(docs, "_id", "_key", "_gone")
    linked = line_components(docs, percent, id_col, text_col)
    placed = _lines(docs, id_col, text_col).select("id", "key", "no", "line").join(linked, "line", "left")
    # Read twice: cutting the texts into lines again would cost more than writing these narrow rows.
    placed = store(placed.select("id", "key", "no", F.coalesce("component", "line").alias("line")), "placed")
    first = placed.groupBy("line").agg(F.min(F.struct("id", "no")).alias("at"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = placed.join(first, "line").where("id <> at.id OR no <> at.no")
    gone = store(gone.groupBy("id", "key").agg(F.collect_set("no").alias(lost)), "gone")
    drop(linked, placed)
    keyed = docs.withColumns({id_: F.col(id_col), key: F.xxhash64(text_col)})
    out = keyed.join(gone.withColumnsRenamed({"id": id_, "key": key}), [id_, key], "left").select(*docs.columns, lost)
    where, names = docs.columns.index(text_col), [*docs.columns, "n_lines", "n_dropped"]
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(where)):
                part = batch.slice(at, len(texts))
                at += len(texts)
                cut = [_left(x, g) for x, g in zip(part.column(where).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True)]
                columns = list(part.columns[:-1])
                columns[where] = pa.array([c[0] for c in cut], columns[where].type)
                yield pa.RecordBatch.from_arrays([*columns, pa.array([c[1] for c in cut], pa.int64()), pa.array([c[2] for c in cut], pa.int64())], names)
    return out.mapInArrow(run, schema)


def _left(text: str | None, gone: list[int] | None) -> tuple[str | None, int, int]:
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    n = sum(1 for x in lines if x.strip(" \t\r"))
    if not gone:
        return text, n, 0
    out = set(gone)
    return "\n".join(x for i, x in enumerate(lines) if i not in out), n, len(out)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, key, no, text, line)``: trimmed, not blank, of rows with an id."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.posexplode(F.split(text_col, "\n")).alias("no", "raw"))
    # Trimming the end looks at every character of a line, so only where there is something to trim.
    ends = F.endswith("raw", F.lit(" ")) | F.endswith("raw", F.lit("\t")) | F.endswith("raw", F.lit("\r"))
    text = F.when(ends, F.expr("trim(BOTH ' \t\r' FROM raw)")).otherwise(F.expr("trim(LEADING ' \t\r' FROM raw)"))
    return rows.withColumn("text", text).where("text <> ''").select("id", "key", "no", "text", F.xxhash64("text").alias("line"))


def char_shingles(column: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``n`` characters (a shorter text is one), and their offsets."""
    data, offsets = flat(column)
    if len(data) and data.max() >= 0x80:
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        codes = _CODES[np.minimum(points, len(_CODES) - 1)]
        far = np.flatnonzero(points >= len(_CODES))
        codes[far] = mix(points[far])
        first = offsets - np.searchsorted(np.flatnonzero((data & 0xC0) == 0x80), offsets)
    else:
        codes, first = _CODES[data], offsets
    size = np.diff(first)
    # Sums of code * base**place over runs; a run's place is divided out by the inverse.
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.multiply(codes, up[: len(codes)], out=sums[1:])
    np.cumsum(sums, out=sums)
    # A run at every place, then those that lie within one text.
    count = max(len(codes) - n + 1, 0)
    run = (sums[n:] - sums[:count]) * down[:count] + np.uint64(n)
    inside = np.ones(count, bool)
    for k in range(1, n):
        last = first[1:] - k
        inside[last[(last >= 0) & (last < count)]] = False
    values, where = mix(run[inside]), np.concatenate([[0], np.cumsum(np.maximum(size - n + 1, 0))])
    few = np.flatnonzero((size > 0) & (size < n))
    if len(few):
        whole = (sums[first[few + 1]] - sums[first[few]]) * down[first[few]] + size[few].astype(np.uint64)
        values = np.insert(values, where[few], mix(whole))
        where = where + np.concatenate([[0], np.cumsum((size > 0) & (size < n))])
    return values, where


def signatures(column: pa.Array) -> np.ndarray:
    """One row of ``BANDS * ROWS`` values per text, from one hash per shingle."""
    values, first = char_shingles(column)
    bins = BANDS * ROWS
    none = np.uint64(0xFFFFFFFF)
    owner = np.repeat(np.arange(len(column)), np.diff(first))
    place = owner * bins + ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    low = np.full(len(column) * bins, none)
    np.minimum.at(low, place, values & np.uint64(0xFFFFFFFE))
    low = low.reshape(-1, bins)
    # The next full bin at or after each, going round.
    full = np.concatenate([low, low], axis=1) != none
    after = np.where(full, np.arange(2 * bins), 2 * bins)
    after = np.minimum.accumulate(after[:, ::-1], axis=1)[:, ::-1][:, :bins]
    out = np.take_along_axis(low, after % bins, axis=1) + ((after - np.arange(bins)).astype(np.uint64) << np.uint64(32))
    return np.where(after < 2 * bins, out, none)


def _bander(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys and lines side by side, packed by the first bits of the key."""
    held, size = [], 0
    for batch in batches:
        lines = batch.column(0).to_numpy()
        _, new = np.unique(lines, return_index=True)
        lines, column = lines[np.sort(new)], batch.column(1).take(pa.array(np.sort(new)))
        at = 0
        for texts in pieces(column, PIECE):
            values = signatures(texts)
            rows = values.reshape(-1, BANDS, ROWS)
            key = np.arange(BANDS, dtype=np.uint64)
            for row in range(ROWS):
                key = mix(key * np.uint64(31) + rows[:, :, row])
            key = (key >> np.uint64(64 - KEY_BITS)).astype(np.int64)
            held.append(np.stack([key.ravel(), np.repeat(lines[at: at + len(texts)], BANDS)], axis=1))
            size += key.size
            at += len(texts)
            if size >= PACK:
                yield _packed(np.concatenate(held))
                held, size = [], 0
    if held:
        yield _packed(np.concatenate(held))


def _packed(pairs: np.ndarray) -> pa.RecordBatch:
    """One row per bucket: its pairs of key and line as bytes."""
    bucket = (pairs[:, 0] >> (KEY_BITS - BUCKET_BITS)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket, pairs = bucket[order], pairs[order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    offsets = (np.append(first, len(pairs)) * pairs.itemsize * 2).astype(np.int32)
    packs = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(pairs)])
    return pa.record_batch([pa.array(bucket[first].astype(np.int32)), packs], ["bucket", "pairs"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines under the same key, each with the next different one, from packs that arrive sorted by bucket.

    A part of at most about ``HELD`` pairs and what a batch adds is looked at at
    once. Of a bucket that goes on one line per key is carried over.
    """
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        pairs = np.frombuffer(b"".join(x.as_buffer() for x in batch.column(1)), np.int64).reshape(-1, 2)
        held.append(pairs)
        size += len(pairs)
        if size >= HELD:
            found, rest = _met(np.concatenate(held))
            held, size = [rest[rest[:, 0] >> (KEY_BITS - BUCKET_BITS) == batch.column(0)[-1].as_py()]], 0
            yield found
    if held:
        yield _met(np.concatenate(held))[0]


def _met(pairs: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
    """Neighbours in the order of key and line, and one pair of every key."""
    pairs = pairs[np.argsort(pairs[:, 0])]
    same = pairs[1:, 0] == pairs[:-1, 0]
    last = pairs[np.append(~same, True)]
    pairs = pairs[np.append(same, False) | np.append(False, same)]
    key, line = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))].T
    near = np.flatnonzero((key[1:] == key[:-1]) & (line[1:] != line[:-1]))
    return pa.record_batch([pa.array(key[near]), pa.array(line[near]), pa.array(line[near + 1])], ["key", "a", "b"]), last


def _sets(column: pa.Array) -> list[np.ndarray]:
    coded = column.dictionary_encode()
    out = []
    for texts in pieces(coded.dictionary, PIECE):
        values, first = char_shingles(texts)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            one = np.sort(values[lo:hi])
            new = one[1:] != one[:-1]
            out.append(one if new.all() else one[np.append(True, new)])
    return [out[i] for i in coded.indices.to_pylist()]
