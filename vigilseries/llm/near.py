"""Near-duplicate documents: LSH forest over word shingles, exact links, components.

Documents with equal shingle sets are one class from the start. Class
representatives get MinHash signatures, cut into trees of ``DEPTH`` values. In
each tree the signatures are put in one sorted order over all partitions.
Neighbours in that order share the longest prefixes there are, so a dense
region is compared at a greater depth than a sparse one; two signatures with
fewer than ``LEAST`` leading values in common are no candidates.

Neighbours connect nearly all of a group, but not every link joins neighbours.
So a second step takes each region (equal first ``LEAST`` values in a tree)
that still holds several components and intersects all its sets across them, in
blocks, as rows of bits. Every link is confirmed on the full shingle sets. One of
similarity s is missed only if no tree has it in one region, a chance of
(1 - s**LEAST) ** TREES, 2e-5 at 0.75, and no other path joins its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilseries.llm.arrays import distinct, grams, mix, pieces, ragged, words
from vigilseries.llm.components import components
from vigilseries.llm.groups import fixed_bytes
from vigilseries.llm.regions import across, confirm, small_semi
from vigilseries.llm.scratch import drop, store

TREES, DEPTH, LEAST = 20, 6, 3
NEIGHBOURS = 4
_EDGE = -1


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked when 100 * |intersection| >= percent * |union| of their
    sets of lower-cased ``n``-word shingles; a shorter text is one shingle. Null
    and empty texts have no shingles and stand alone. Rows that repeat an id are
    one document with several sets; a null id takes no part and keeps itself
    (``component_id`` null, ``kept`` true). Ids are integers.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    seen = store(rows.mapInArrow(_signer(n), "id bigint, n_shingles bigint, h1 bigint, h2 bigint, signature binary"), "signatures")
    able = seen.where("id IS NOT NULL AND n_shingles > 0")
    classes = store(able.groupBy("h1", "h2", "n_shingles").agg(F.min("id").alias("rep")), "classes")
    heads = able.join(classes, ["h1", "h2", "n_shingles"]).where("id = rep").dropDuplicates(["id", "h1"]) \
        .select("id", "signature").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    forest = store(heads.select("id", "tree", F.expr(f"substring(signature, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("label")), "forest")
    near = store(_neighbours(forest), "neighbours")
    involved = store(near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "involved")
    sets = store(small_semi(rows.where("id IS NOT NULL"), involved).mapInArrow(_setter(n), "id bigint, shingles binary"), "sets")

    first = confirm(_nearest(near), sets, percent)
    first = store(first, "links")
    grouped = components(first)
    regions = small_semi(forest, involved).select("id", F.concat(F.encode(F.col("tree").cast("string"), "utf-8"), F.substring("label", 1, 4 * LEAST)).alias("region"))
    rest = store(across(regions, sets, grouped, percent), "links")
    same = able.join(classes, ["h1", "h2", "n_shingles"]).select("id", "rep")
    # A repeated id with several sets joins its classes, so ids link to representatives like documents do.
    repeated = same.where("id <> rep").groupBy("id").agg(F.min("rep").alias("rep"), F.max("rep").alias("_last"))
    several = same.join(repeated.where("rep <> _last").select("id"), "id").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    found = store(components(first.unionByName(rest).unionByName(several)), "components")
    drop(forest, near, involved, sets, first, rest, grouped)

    up = found.select(F.col("node").alias("rep"), "component")
    out = seen.select("id", "n_shingles", "h1", "h2").join(classes, ["h1", "h2", "n_shingles"], "left").join(up, "rep", "left")
    own = F.least(F.coalesce("component", "rep", "id"), F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", own.alias("component_id"),
                      F.coalesce(own == F.col("id"), F.lit(True)).alias("kept"))


def _shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    found = words(column, lower=True)
    return distinct(*grams(found.hashes, found.first, n, short=True))


def _signer(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(1)):
                values, first = _shingles(texts, n)
                signature = np.empty((len(texts), len(seeds)), ">u4")
                for k, seed in enumerate(seeds):
                    scrambled = ((values * seed) >> np.uint64(32)).astype(np.uint32)
                    signature[:, k] = ragged(np.minimum, scrambled, first, np.uint32(0xFFFFFFFF))
                h1, h2 = ragged(np.add, mix(values), first, np.uint64(0)), ragged(np.bitwise_xor, mix(values + np.uint64(11)), first, np.uint64(0))
                yield pa.record_batch([
                    batch.column(0).slice(at, len(texts)), pa.array(np.diff(first)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                    pa.array([r.tobytes() for r in signature], pa.binary()),
                ], ["id", "n_shingles", "h1", "h2", "signature"])
                at += len(texts)
    return run


def _setter(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(1)):
                values, first = _shingles(texts, n)
                yield pa.record_batch([batch.column(0).slice(at, len(texts)),
                                       pa.array([values[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                                      ["id", "shingles"])
                at += len(texts)
    return run


def _neighbours(forest: DataFrame) -> DataFrame:
    """``(a, b, trees)``: neighbours in a sorted order that share a prefix, and in how many trees they do."""
    keys = ["tree", "label", "id"]
    spread = forest.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    pairs = store(spread.select("part", *keys).mapInArrow(_adjacent, "a bigint, b bigint, part int, tree int, label binary"), "adjacent")
    # The first and last row of each partition meet on the driver: two rows per partition.
    ends = sorted(tuple(r) for r in pairs.where(f"b = {_EDGE} AND label IS NOT NULL").select("part", "tree", "label", "a").collect())
    crossing = [(x[3], y[3]) for x, y in zip(ends, ends[1:], strict=False)
                if x[0] != y[0] and x[1] == y[1] and x[2][: 4 * LEAST] == y[2][: 4 * LEAST]]
    extra = forest.sparkSession.createDataFrame(crossing, "a bigint, b bigint")
    both = pairs.where("label IS NULL").select("a", "b").unionByName(extra).where("a <> b")
    return both.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("trees"))


def _adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["a", "b", "part", "tree", "label"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part, tree, label, ids = batch.column(0), batch.column(1).to_numpy(), batch.column(2), batch.column(3).to_numpy()
        prefix = fixed_bytes(label, np.uint8)[:, : 4 * LEAST]
        edge = [len(ids) - 1]
        if last is not None:
            tree, prefix, ids = np.append(last[0], tree), np.vstack([last[1], prefix]), np.append(last[2], ids)
        else:
            edge = [0, *edge]
        near = np.flatnonzero((tree[1:] == tree[:-1]) & (prefix[1:] == prefix[:-1]).all(axis=1))
        last = tree[-1:], prefix[-1:], ids[-1:]
        none = pa.nulls(len(near), pa.binary())
        zero = np.zeros(len(near), np.int32)
        yield pa.record_batch([pa.array(ids[near]), pa.array(ids[near + 1]), pa.array(zero), pa.array(zero), none], names)
        rows = [(batch.column(3)[i].as_py(), _EDGE, part[i].as_py(), batch.column(1)[i].as_py(), label[i].as_py()) for i in edge]
        yield pa.record_batch([pa.array([r[k] for r in rows], kinds[k]) for k in range(5)], names)


def _nearest(near: DataFrame) -> DataFrame:
    """The neighbours met in most trees, a few per document; at most two per tree come in."""
    sides = near.select(F.col("a").alias("id"), "*").unionByName(near.select(F.col("b").alias("id"), "*"))
    order = Window.partitionBy("id").orderBy(F.desc("trees"), "a", "b")
    return sides.withColumn("_r", F.row_number().over(order)).where(f"_r <= {NEIGHBOURS}").select("a", "b").distinct()
