"""Exact links between sets that share a region: pairs by join, whole regions by bit rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.groups import whole_groups
from vigilseries.llm.scratch import store

BLOCK = 1024
COLUMNS = 1 << 15
BROADCAST_IDS = 1 << 21
#: Up to so many pairs a set are intersected one by one, which is quicker than bit rows.
FEW = 2


Read = Callable[[pa.Array], list[np.ndarray]]


def as_sets(column: pa.Array) -> list[np.ndarray]:
    """Stored sets: sorted 64-bit hashes as bytes."""
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def small_semi(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows with a listed id; the list is broadcast only after counting it."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def across(regions: DataFrame, sets: DataFrame, grouped: DataFrame, percent: int, read: Read = as_sets, least: int = 2) -> DataFrame:
    """Links inside one region between different components; large regions are dealt as pairs of blocks.

    ``regions`` has (id, region), ``sets`` (id, shingles), read by ``read``;
    ``grouped`` are the components found so far. Only regions with several components are looked at, and with
    ``least`` sets or more: where both of two were compared before, 3 leaves out what is known not to be a link.
    """
    held = regions.join(grouped.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    held = store(held, "regions")
    mixed = mixed_regions(held, least).select("region", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = held.join(mixed, ["region"]).withColumn("block", block).join(sets, "id")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("other", other).select(
        "region", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "id", "component", "shingles")
    keys = ["region", "x", "y"]
    run = _linker(percent, read)
    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a bigint, b bigint").distinct()


def mixed_regions(held: DataFrame, least: int) -> DataFrame:
    """``(region, size)`` with several components; of regions that hold the same sets, one."""
    digest = F.xxhash64("id")
    mixed = held.groupBy("region").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"),
        F.sum(F.shiftright(digest, 32)).alias("upper"), F.sum(digest.bitwiseAND(0xFFFFFFFF)).alias("lower"))
    mixed = mixed.where(f"lo <> hi AND size >= {least}")
    return mixed.groupBy("size", "upper", "lower").agg(F.min("region").alias("region"))


def _linker(percent: int, read: Read):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in whole_groups(batches, ["region", "x", "y"]):
            ids, comp = table.column("id").to_numpy(), table.column("component").to_numpy()
            sets = read(table.column("shingles").combine_chunks())
            found = []
            for lo, hi in zip(first[:-1], first[1:], strict=True):
                i, j = _linked(sets[lo:hi], comp[lo:hi], percent)
                if len(i):
                    i, j = _spanning(i, j, comp[lo:hi])
                    found.append(np.stack([ids[lo + i], ids[lo + j]]))
            if not found:
                continue
            pair = np.sort(np.concatenate(found, axis=1), axis=0)
            yield pa.record_batch([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])
    return run


def _spanning(i: np.ndarray, j: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As many of the links as it takes to join the same components."""
    pair = np.sort(np.stack([comp[i], comp[j]]), axis=0)
    sides, at = np.unique(pair, axis=1, return_index=True)
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x
    keep = []
    for a, b, k in zip(*sides.tolist(), at, strict=True):
        a, b = top(a), top(b)
        if a != b:
            up[b] = a
            keep.append(k)
    return i[keep], j[keep]


def _linked(sets: list[np.ndarray], comp: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets from different components that are similar enough."""
    size = np.array([len(s) for s in sets])
    # Sets of too different sizes cannot be similar enough.
    able = (100 * np.minimum(size[:, None], size) >= percent * np.maximum(size[:, None], size)) & (comp[:, None] != comp)
    i, j = np.nonzero(np.triu(able, 1))
    if len(i) <= FEW * len(sets):
        both = np.array([_shared(sets[x], sets[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    else:
        both = _intersections(sets)[i, j].astype(np.int64)
    fit = 100 * both >= percent * (size[i] + size[j] - both)
    return i[fit], j[fit]


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sorted arrays without repeats have in common."""
    both = np.sort(np.concatenate([x, y]))
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from bit rows over the values that more than one set has."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[code]
    owner, code = owner[keep], number[code[keep]]
    both = np.zeros((len(sets), len(sets)), np.int32)
    for lo in range(0, int(shared.sum()), COLUMNS):
        here = (code >= lo) & (code < lo + COLUMNS)
        width = min(COLUMNS, int(shared.sum()) - lo)
        bits = np.zeros((len(sets), -(-width // 64) * 64), bool)
        bits[owner[here], code[here] - lo] = True
        rows = np.packbits(bits, axis=1).view(np.uint64)
        for i in range(len(sets) - 1):
            both[i, i + 1:] += np.bitwise_count(rows[i] & rows[i + 1:]).sum(axis=1, dtype=np.int32)
    return both


def confirm(pairs: DataFrame, sets: DataFrame, percent: int, read: Read = as_sets) -> DataFrame:
    """Pairs similar enough on their full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(read(batch.column(2)), read(batch.column(3)), strict=True)):
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = _shared(x, y)
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")
