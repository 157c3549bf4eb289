"""Distributed LSD radix sort: stable counting passes over the digits of composite keys.

Rows stand in blocks of equal length. A pass ranks the rows of every block and
digit in their present order, counts them, and turns the counts into
destinations: all rows of smaller digits, rows of the same digit in earlier
blocks, then the rank. Rows move to the block of their destination. Passes go
from the lowest digit to the highest, so after the last one a row's destination
is its place in the whole order. Blocks hold the same number of rows whatever
the keys are, so no key makes a task larger than another.

The driver sees one count per digit (``1 << DIGIT_BITS`` at most); the counts per
digit and block stay distributed. Each pass is written, so a lost executor
repeats one pass at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilseries.llm.scratch import drop, store

DIGIT_BITS = 12
BLOCK_ROWS = 1 << 17


def digits(keys: list[tuple[Column, int]]) -> list[tuple[Column, int]]:
    """``(digit, bits)`` from the lowest on, for keys of so many bits, the most significant key first.

    A key is a 64-bit number read as unsigned; its bits above the given ones are 0.
    """
    out = []
    for key, bits in reversed(keys):
        passes = -(-bits // DIGIT_BITS)
        width = -(-bits // max(passes, 1))
        out += [(F.shiftrightunsigned(key, k * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int"), width) for k in range(passes)]
    return out


def radix_places(rows: DataFrame, keys: list[tuple[Column, int]], place: str = "place") -> DataFrame:
    """All rows and columns and ``place``, the 0-based place in the order of the keys.

    Rows with equal keys keep the order in which they were written. The result is stored.
    """
    taken = {place, "_digit", "_block", "_rank"} & set(rows.columns)
    if taken:
        raise ValueError(f"columns would be overwritten: {sorted(taken)}")
    names = rows.columns
    current = store(rows, "unsorted")
    n = current.count()
    blocks = max(1, min(n, max(-(-n // BLOCK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)))
    length = max(1, -(-n // blocks))
    here, passes = current.withColumn("_block", F.spark_partition_id().cast("bigint")), digits(keys)
    for at, (digit, bits) in enumerate(passes):
        ranked = store(here.select("*", digit.alias("_digit")).mapInArrow(_ranker(bits), T.StructType(
            [*here.schema.fields, T.StructField("_digit", T.IntegerType()), T.StructField("_rank", T.LongType())])), "ranked")
        drop(current)
        current = ranked
        moved = ranked.join(_offsets(ranked), ["_digit", "_block"]).select(*names, (F.col("_before") + F.col("_rank")).alias(place))
        if at + 1 < len(passes):
            dealt = moved.withColumn("_block", F.expr(f"{place} div {length}L"))
            here = dealt.repartition(int(blocks), "_block").sortWithinPartitions(place).drop(place)
    if not passes:
        raise ValueError("keys without bits")
    out = store(moved, "sorted")
    drop(current)
    return out


def _offsets(ranked: DataFrame) -> DataFrame:
    """``(_digit, _block, _before)``: where the first row of a digit in a block goes."""
    counts = store(ranked.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = dict(counts.groupBy("_digit").agg(F.sum("n")).collect())
    smaller = [0, *accumulate(totals.get(d, 0) for d in range(max(totals, default=0)))]
    base = F.element_at(F.expr(f"CAST(split('{','.join(map(str, smaller))}', ',') AS ARRAY<BIGINT>)"), F.col("_digit") + 1)
    earlier = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_digit", "_block", (base + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("_before"))


def _ranker(bits: int):
    """Rank of each row among those of its block and digit; blocks come whole and in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = None, np.zeros(1 << bits, np.int64)
        for batch in batches:
            digit = batch.column(batch.num_columns - 1).to_numpy()
            where = batch.column(batch.num_columns - 2).to_numpy()
            edges = [0, *(np.flatnonzero(where[1:] != where[:-1]) + 1), len(where)]
            rank = np.zeros(len(digit), np.int64)
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                if where[lo] != block:
                    block, seen = where[lo], np.zeros(1 << bits, np.int64)
                part = digit[lo:hi]
                order = np.argsort(part, kind="stable")
                count = np.bincount(part, minlength=1 << bits)
                inside = np.arange(hi - lo) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
                rank[lo + order] = seen[part[order]] + inside
                seen += count
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank)], [*batch.schema.names, "_rank"])
    return run
