"""Sharding by a minimax contiguous partition: equal texts stay together, the largest shard is as small as can be.

Documents with equal text are one atomic group; groups stand in the order of
their smallest id. Over the running sums of the group sizes, the smallest shard
capacity is found by binary search, checking each capacity greedily: a shard
reaches to the last running sum that fits. The running sums stay distributed.
The driver holds some of them and, for every gap between two neighbours, whether
others lie in it; so each capacity is known to fit, known not to, or undecided.
Only the gaps that undecided capacities depend on are looked into, in one job of
at most ``POINTS`` answers a round, until none is left: the result is exact.

Cuts fall at that capacity. Where it leaves slack (one group larger than an even
share), they are placed as evenly as the known sums allow without exceeding it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.scratch import drop, store
from vigilseries.operators.layout import index_rows

POINTS = 1 << 14
HOT_SHARE = 1024
GROUP = ["key", "size", "text_crc32"]


def shard_groups(docs: DataFrame, n_shards: int = 16, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(key, size, text_crc32, rows, end, shard)``: one row per different text; ``end`` is the running sum up to it."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    return _cut_groups(_measured(docs, id_col, text_col), n_shards)


def assign_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 1; a null text counts as an empty one
    and shares its group. Slots count a shard's rows from 0 in group order, then
    by id. Rows may repeat ids or have none (a null id comes first) and each gets
    a slot of its own. With fewer groups than shards some shards stay empty. No
    other column of ``docs`` is read.
    """
    rows = store(_measured(docs, id_col, text_col), "measured")
    groups = store(_cut_groups(rows, n_shards), "groups")
    placed = index_rows(with_shard(rows, groups, "shard", "end"), ["end", "id"], ["shard"], "slot")
    drop(rows, groups)
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                 file_bytes: int = 1 << 28) -> DataFrame:
    """Write ``docs`` to ``path/shard=N`` in files of about ``file_bytes`` of text; the number and bytes of rows per shard.

    A shard is dealt to its files by row, so neither a large shard nor a group
    of copies goes to one task. A column ``shard`` of ``docs`` is replaced.
    """
    docs = docs.drop("shard")
    groups = store(shard_groups(docs, n_shards, text_col, id_col), "groups")
    facts = store(groups.groupBy("shard").agg(F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("size")).alias("bytes")), "shards")
    files = 1 + (facts.agg(F.max("bytes")).first()[0] or 0) // file_bytes
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), *_group_columns(text))
    file = F.pmod(F.xxhash64("_doc"), F.lit(files))
    out = with_shard(whole, groups, "shard").repartition("shard", file)
    out.select("_doc.*", "shard").write.partitionBy("shard").parquet(path)
    drop(groups)
    return facts


def _group_columns(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("key"), (F.octet_length(text).cast("bigint") + 1).alias("size"), F.crc32(text).alias("text_crc32")]


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), *_group_columns(F.coalesce(F.col(text_col), F.lit(""))))


def with_shard(rows: DataFrame, groups: DataFrame, *names: str) -> DataFrame:
    """``rows`` with columns of their group. Groups of very many rows are broadcast: a group has one of every
    ``HOT_SHARE`` rows at least to count as such, so there are at most that many; the others are joined."""
    total = groups.agg(F.sum("rows")).first()[0] or 0
    hot = F.col("rows") * HOT_SHARE >= F.lit(int(total))
    some = groups.select(*GROUP, *names, "rows")
    met = rows.join(F.broadcast(some.where(hot).drop("rows")), GROUP, "left")
    rest = met.where(F.col(names[0]).isNull()).drop(*names).join(some.where(~hot).drop("rows"), GROUP)
    return met.where(F.col(names[0]).isNotNull()).unionByName(rest)


def _cut_groups(rows: DataFrame, n_shards: int) -> DataFrame:
    groups = rows.groupBy(*GROUP).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    order = ["first", "key", "size", "text_crc32"]
    sums = groups.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    sums = store(sums.select(*GROUP, "rows", "part").mapInArrow(_running, "key bigint, size bigint, text_crc32 bigint, rows bigint, part int, end bigint, no bigint"), "sums")
    # One row per partition.
    parts = sorted(sums.groupBy("part").agg(F.max("end").alias("end"), F.max("no").alias("no")).collect())
    before = {name: dict(zip([p["part"] for p in parts], [0, *accumulate(p[name] for p in parts)], strict=False)) for name in ("end", "no")}
    ends = sums.select(*GROUP, "rows", *[(F.col(n) + _by_part(before[n])).alias(n) for n in ("end", "no")])
    cuts = smallest_capacity(ends, sum(p["end"] for p in parts), sum(p["no"] for p in parts), n_shards)[1]
    shard = F.size(F.filter(F.lit(cuts[:-1]).cast("array<bigint>"), lambda c: c < F.col("end"))) if len(cuts) > 1 else F.lit(0)
    return ends.select(*GROUP, "rows", "end", shard.alias("shard"))


def _by_part(before: dict[int, int]) -> Column:
    whole = [before.get(p, 0) for p in range(1 + max(before, default=0))]
    return F.element_at(F.expr(f"CAST(split('{','.join(map(str, whole))}', ',') AS ARRAY<BIGINT>)"), F.col("part") + 1)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running bytes and running number of the groups of one partition."""
    end, no = 0, 0
    for batch in batches:
        sums = end + np.cumsum(batch.column(1).to_numpy() * batch.column(3).to_numpy())
        numbers = no + 1 + np.arange(batch.num_rows)
        if batch.num_rows:
            end, no = int(sums[-1]), int(numbers[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums), pa.array(numbers)], [*batch.schema.names, "end", "no"])


def smallest_capacity(ends: DataFrame, total: int, groups: int, n_shards: int) -> tuple[int, list[int]]:
    """The smallest capacity for which ``n_shards`` shards hold everything, and the ``n_shards`` cuts.

    ``ends`` has the running sum ``end`` and the number ``no`` (from 1) of every
    group, ``total`` and ``groups`` are the last ones.
    """
    sums = KnownSums(total, groups)
    while True:
        least, most = sums.least(n_shards, sure=False), sums.least(n_shards, sure=True)
        if least == most:
            return most, sums.even_cuts(n_shards, most)
        sums.add(_look(ends, sums.undecided(n_shards, least, most)))


def _look(ends: DataFrame, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The last running sum in each of many equal parts of the ranges ``(lo, hi]``; at most ``POINTS`` rows come back."""
    bins = POINTS // len(ranges)
    part = None
    for k, (lo, hi) in enumerate(ranges):
        width = -(-(hi - lo) // bins)
        found = F.expr(f"{k * bins}L + (end - {lo + 1}L) div {width}L")
        inside = F.col("end").between(F.lit(lo + 1), F.lit(hi))
        part = F.when(inside, found) if part is None else part.when(inside, found)
    rows = ends.select(part.alias("part"), "end", "no").where("part IS NOT NULL").groupBy("part").agg(F.max("end").alias("end"), F.max("no").alias("no"))
    return [(r["end"], r["no"]) for r in rows.collect()]


class KnownSums:
    """Some running sums with their numbers, sorted. Between two with consecutive numbers there is no other."""

    def __init__(self, total: int, groups: int):
        self.total, self.points, self.numbers = total, np.array([0, total] if total else [0]), np.array([0, groups] if total else [0])

    def add(self, found: list[tuple[int, int]]) -> None:
        points = np.concatenate([self.points, np.array([p for p, _ in found], np.int64)])
        numbers = np.concatenate([self.numbers, np.array([n for _, n in found], np.int64)])
        self.points, at = np.unique(points, return_index=True)
        self.numbers = numbers[at]

    def reach(self, x: int, sure: bool) -> int:
        """The last sum up to ``x``: the last known one, or, unless ``sure``, the most it can be."""
        if x >= self.total:
            return self.total
        at = int(np.searchsorted(self.points, x, side="right")) - 1
        settled = sure or self.numbers[at + 1] - self.numbers[at] == 1
        return int(self.points[at]) if settled else x

    def greedy(self, n_shards: int, capacity: int, sure: bool) -> list[int]:
        return list(accumulate(range(n_shards), lambda at, _: self.reach(at + capacity, sure), initial=0))[1:]

    def least(self, n_shards: int, sure: bool) -> int:
        """Binary search of the smallest capacity whose greedy cuts reach the end."""
        lo, hi = -(-self.total // n_shards), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if self.greedy(n_shards, mid, sure)[-1] >= self.total else (mid + 1, hi)
        return lo

    def undecided(self, n_shards: int, least: int, most: int) -> list[tuple[int, int]]:
        """Disjoint ranges between known sums that hold unknown ones and that greedy cuts of these capacities can fall into."""
        starts, ends = [0, *self.greedy(n_shards, least, True)[:-1]], [0, *self.greedy(n_shards, most, False)[:-1]]
        out: list[tuple[int, int]] = []
        for a, b in zip(starts, ends, strict=True):
            lo = int(np.searchsorted(self.points, min(a + least, self.total), side="right")) - 1
            hi = int(np.searchsorted(self.points, min(b + most, self.total), side="left"))
            for at in range(lo, min(hi, len(self.points) - 1)):
                if self.numbers[at + 1] - self.numbers[at] > 1:
                    gap = int(self.points[at]), int(self.points[at + 1])
                    if out and out[-1][1] == gap[0]:
                        out[-1] = out[-1][0], gap[1]
                    elif not out or out[-1][1] < gap[1]:
                        out.append(gap)
        return out

    def even_cuts(self, n_shards: int, capacity: int) -> list[int]:
        """Ends of the shards: none above the capacity, each as near to an even share of what is left as that allows."""
        needed = [self.total]
        for _ in range(n_shards - 1):
            needed.append(int(self.points[np.searchsorted(self.points, max(needed[-1] - capacity, 0))]))
        cuts, at = [], 0
        for left, least in zip(range(n_shards, 0, -1), reversed(needed), strict=True):
            most = self.reach(at + capacity, True)
            able = self.points[(self.points >= min(max(least, at), most)) & (self.points <= most)]
            at = int(able[np.abs(able - (at + (self.total - at) / left)).argmin()])
            cuts.append(at)
        return cuts
