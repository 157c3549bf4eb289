"""Repeated passages: words covered by a window that also starts earlier in the corpus.

Every window of ``window`` words is represented by the smallest hash among its
``MARK``-word runs, its mark; equal windows have equal marks. Consecutive
windows with one mark make a segment. Marks met once (nearly all) end there;
segments with other marks are dealt to shards by their mark, so all copies of a
window are in one shard, and each document is streamed only through the shards
of its own marks. A shard indexes its segments in document order and finds, by
backward search, the interval of every window; a window goes if one in its
interval has an earlier place (id, start) than its own.

Equal segments are reduced to the first of them before they are dealt (the
others are covered as a whole). A mark with more than ``HOT`` different segments
is dealt window by window instead, each window to the minimum of its places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.arrays import grams, mix, pieces, words
from vigilseries.llm.fm import FMIndex
from vigilseries.llm.scratch import drop, store

MARK = 8
HOT = 20_000
BROADCAST_MARKS = 1 << 22
SHARD_WORDS = 1 << 20
QUERIES_AT_ONCE = 1 << 16


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept`` (words left, joined by one space).

    A place is (id, start), ids are integers. Null and empty texts have no words
    and keep "". Rows with a null id are returned whole and cover nothing. Rows
    that repeat an id cover each other only from an earlier start. Texts shorter
    than the window lose nothing.
    """
    if window <= MARK:
        raise ValueError(f"a window must be longer than {MARK} words")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    able = rows.where("id IS NOT NULL AND text IS NOT NULL")
    marks = able.select("text").mapInArrow(_marker(window), "mark bigint")
    repeated = store(marks.groupBy("mark").count().where("count > 1").select("mark"), "marks")
    found = able.mapInArrow(_segmenter(window), "mark bigint, id bigint, key bigint, start int, windows int, words binary")
    few = repeated.count() <= BROADCAST_MARKS
    found = found.join(F.broadcast(repeated) if few else repeated, "mark", "left_semi")
    segments = store(found.withColumn("content", F.xxhash64("words")), "segments")
    drop(repeated)

    place = F.struct("id", "start", "key")
    firsts = store(segments.groupBy("mark", "content").agg(F.min(place).alias("at"), F.min_by(F.struct("windows", "words"), place).alias("of"))
                   .select("mark", "content", "at.*", "of.*"), "firsts")
    heads = firsts.select("mark", "content", F.col("id").alias("first_id"), F.col("start").alias("first_start"))
    met = segments.drop("words").join(heads, ["mark", "content"])
    # Another row of the same id with the segment at the same place: as early as the first one, so it is searched too.
    first_key = F.col("key").alias("first_key")
    twins = store(met.where("id = first_id AND start = first_start").join(firsts.select("mark", "content", first_key), ["mark", "content"])
                  .where("key <> first_key").select("mark", "content", F.col("key").alias("twin_key")).distinct(), "twins") if _repeated_ids(able) else None
    if twins is not None:
        again = firsts.join(twins, ["mark", "content"]).withColumn("key", F.col("twin_key")).select(*firsts.columns)
        firsts = store(firsts.unionByName(again), "firsts")
    copies = met.where("id <> first_id OR start <> first_start").select("id", "key", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + (window - 1)).alias("hi"))

    hot = store(firsts.groupBy("mark").count().where(f"count > {HOT}").select("mark"), "hot")
    calm = firsts.join(hot, "mark", "left_anti")
    shards = 1 + (firsts.agg(F.sum(F.length("words")).alias("n")).first()["n"] or 0) // (8 * SHARD_WORDS)
    dealt = calm.repartition(max(int(shards), docs.sparkSession.sparkContext.defaultParallelism), "mark").sortWithinPartitions("id", "start")
    spans = "id bigint, key bigint, lo int, hi int"
    covered = dealt.select("id", "key", "start", "windows", "words").mapInArrow(_searcher(window), spans)
    ranges = store(copies.unionByName(covered).unionByName(_hot_windows(firsts.join(hot, "mark", "left_semi"), window))
                   .groupBy("id", "key").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
                   .select("id", "key", F.col("ranges.lo").alias("lo"), F.col("ranges.hi").alias("hi")), "ranges")
    drop(segments, firsts, hot)
    left = rows.join(ranges, ["id", "key"], "left").select("id", "text", "lo", "hi")
    out = left.mapInArrow(_cut, "id bigint, n_words bigint, n_removed bigint, kept string")
    return out.withColumnRenamed("id", id_col)


def _repeated_ids(rows: DataFrame) -> bool:
    """Whether two rows with different texts share an id."""
    return not rows.groupBy("id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").isEmpty()


def _hot_windows(firsts: DataFrame, window: int) -> DataFrame:
    """Windows of marks with very many segments: all but the first place of each are covered."""
    each = firsts.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("windows") - 1)))
    each = each.select("id", "key", (F.col("start") + F.col("k")).alias("start"), F.expr(f"substring(words, 8 * k + 1, {8 * window})").alias("w"))
    low = each.groupBy("w").agg(F.min(F.struct("id", "start")).alias("at"))
    return each.join(low, "w").where("id <> at.id OR start <> at.start").select(
        "id", "key", F.col("start").alias("lo"), (F.col("start") + window).alias("hi"))


def _runs(column: pa.Array, window: int):
    """Segments of some texts: text, first window, number of windows, mark; and the words."""
    found = words(column)
    code, first = grams(found.hashes, found.first, MARK)
    width = window - MARK + 1
    at, reach = np.arange(len(code)), 1
    order = mix(code)
    while reach < width:
        step = min(reach, width - reach)
        other = np.append(at[step:], np.full(min(step, len(at)), len(at) - 1))
        at = np.where(order[other] < order[at], other, at)
        reach += step
    many = np.maximum(np.diff(first) - width + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(many)])
    owner = np.repeat(np.arange(len(many)), many)
    start = np.arange(offsets[-1]) - offsets[owner]
    low = at[first[owner] + start]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(low)))
    return found, owner[begin], start[begin], length, code[low[begin]].view(np.int64)


def _marker(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column(0)):
                yield pa.record_batch([pa.array(_runs(texts, window)[4])], ["mark"])
    return run


def _segmenter(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(2), 1 << 20):
                found, owner, start, length, mark = _runs(texts, window)
                size = length + window - 1
                offsets = np.concatenate([[0], np.cumsum(size)])
                index = np.arange(offsets[-1]) + np.repeat(found.first[owner] + start - offsets[:-1], size)
                body = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((8 * offsets).astype(np.int32)), pa.py_buffer(found.hashes[index])])
                row = pa.array(owner + at)
                yield pa.record_batch([pa.array(mark), batch.column(0).take(row), batch.column(1).take(row),
                                       pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32)), body],
                                      ["mark", "id", "key", "start", "windows", "words"])
                at += len(texts)
    return run


def _searcher(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        shard = pa.Table.from_batches(held).combine_chunks()
        windows = shard.column("windows").to_numpy()
        body = np.frombuffer(b"".join(shard.column("words").to_pylist()), np.uint64)
        size = windows + (window - 1)
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        # Words become numbers from 1; a 0 ends each segment.
        _, number = np.unique(body, return_inverse=True)
        text = np.insert(number + 1, begin + size, 0)
        begin = begin + np.arange(len(size))
        index = FMIndex(text, window)
        offsets = np.concatenate([[0], np.cumsum(windows)])
        owner = np.repeat(np.arange(len(windows)), windows)
        place = np.arange(offsets[-1]) - offsets[owner] + begin[owner]
        interval = np.concatenate([np.zeros(0, np.int64), *(index.search(text, place[lo: lo + QUERIES_AT_ONCE], window)[0]
                                                            for lo in range(0, len(place), QUERIES_AT_ONCE))])
        # Equal windows have one interval, and all that lie in it are asked for here.
        rank = _ranks(shard.column("id").to_numpy()[owner], shard.column("start").to_numpy()[owner] + place - begin[owner])
        earliest = np.full(len(text) + 1, len(place))
        np.minimum.at(earliest, interval, rank)
        hit = earliest[interval] < rank
        new = hit.copy()
        new[1:] &= ~hit[:-1] | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        end = hit.copy()
        end[:-1] &= ~hit[1:] | (owner[1:] != owner[:-1])
        last = np.flatnonzero(end)
        rows = shard.take(pa.array(owner[first]))
        start = rows.column("start").to_numpy() - begin[owner[first]]
        yield pa.record_batch([rows.column("id").combine_chunks(), rows.column("key").combine_chunks(),
                               pa.array((place[first] + start).astype(np.int32)), pa.array((place[last] + start + window).astype(np.int32))],
                              ["id", "key", "lo", "hi"])
    return run


def _ranks(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Dense ranks of (id, start)."""
    order = np.lexsort((starts, ids))
    new = (np.diff(ids[order], prepend=ids[order[:1]]) != 0) | (np.diff(starts[order], prepend=starts[order[:1]]) != 0)
    out = np.empty(len(ids), np.int64)
    out[order] = np.cumsum(new)
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leave out the words in a text's ranges."""
    for batch in batches:
        at = 0
        for texts in pieces(batch.column(1)):
            part = batch.slice(at, len(texts))
            at += len(texts)
            found = words(texts, hashed=False)
            depth = np.zeros(len(found.starts) + 1, np.int64)
            for name, sign in (("lo", 1), ("hi", -1)):
                column = part.column(name)
                edges = column.flatten().to_numpy(zero_copy_only=False)
                each = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
                np.add.at(depth, np.repeat(found.first[:-1], each) + edges.astype(np.int64), sign)
            keep = np.cumsum(depth[:-1]) == 0
            total = np.concatenate([[0], np.cumsum(keep)])
            first = total[found.first]
            yield pa.record_batch([part.column(0), pa.array(found.counts), pa.array(found.counts - np.diff(first)),
                                   joined(found.data, found.starts[keep], found.ends[keep], first)],
                                  ["id", "n_words", "n_removed", "kept"])


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> pa.Array:
    """Texts of byte ranges joined by one space; text ``i`` takes ranges ``first[i]:first[i + 1]``."""
    padded = np.append(data, np.uint8(0x20))
    size = ends - starts + 1
    ends_text = first[1:][np.diff(first) > 0] - 1
    size[ends_text] -= 1
    offsets = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)
    gaps = np.delete(offsets[1:] - 1, ends_text)
    index[gaps] = len(data)
    return pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(offsets[first]), pa.py_buffer(padded[index])]).cast(pa.string())
