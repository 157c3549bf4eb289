"""Exact top-k inner products: vectors by falling length, rotated partial sums, Cauchy-Schwarz bounds.

Candidates are range-partitioned by falling length into blocks. An orthogonal
rotation (the singular vectors of all vectors, from a sum of one small matrix
per task) moves most of a product into the first coordinates. In a block, a
query's product with a vector is at most its partial sum over these plus the
product of the two residual lengths; vectors whose bound stays below the query's
k-th best so far are passed over, and a block is left as soon as the product of
whole lengths does. What remains is computed in integers. The first block gives
each query a k-th best score; other blocks are not sent queries they cannot help.

Queries meet candidates in pairs of blocks; each pair returns at most k rows per
query, so work and memory of a task are bounded by the two block sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilseries.llm.fold import folded
from vigilseries.llm.scratch import drop, store

SCALE = 1024
LARGEST = 2.0 ** 500
LONG = float(1 << 63)
BLOCK = 8192
QUERIES = 1024
CHUNK = 512
HEAD = 4
ROTATED = 1024
FLOAT_EXACT = float(1 << 52)
#: Partial scores beyond a long are held at its ends; among the best they are an error.
ENDS = -np.iinfo(np.int64).max, np.iinfo(np.int64).max


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, v)`` with v = floor(1024 * component), whole numbers as doubles, which hold them exactly.

    Left out: null ids, null vectors, and vectors with a null or non-finite
    component. A component beyond 2**500 after scaling is an error.
    """
    whole = df[vector_col]
    rows = df.where(F.col(id_col).isNotNull() & whole.isNotNull() & ~F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    floor = F.transform(F.col(vector_col), lambda x: _floored(x.cast("double") * SCALE))
    return rows.select(F.col(id_col).cast("bigint").alias("id"), floor.alias("v"))


def _floored(x):
    """Doubles from 2**52 on are whole; beyond ``LARGEST`` squares would not be finite."""
    far = F.raise_error(F.lit("a component is too large")).cast("double")
    return F.when(F.abs(x) < FLOAT_EXACT, F.floor(x).cast("double")).when(F.abs(x) <= LARGEST, x).otherwise(far)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for ``(id, v)`` frames of integer vectors.

    Only vectors of a query's own dimension are compared with it, never those of
    its own id. Ties go to the smaller id. Fewer than k candidates are returned
    whole. Queries that repeat an id and a vector count once. Scores are exact; a
    returned score that does not fit a long is an error.
    """
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    vectors, queries = (d.withColumn("v", F.col("v").cast("array<double>")) for d in (vectors, queries))
    base = store(vectors.select("id", "v", F.size("v").alias("dim"), F.sqrt(length).alias("length")), "vectors")
    blocks = 1 + base.count() // BLOCK
    placed = base.repartitionByRange(int(blocks), "dim", F.desc("length"), "id").withColumn("block", F.spark_partition_id())
    placed = store(placed, "placed")
    asked = queries.select("id", "v", F.size("v").alias("dim"), F.sqrt(length).alias("length"), F.xxhash64("v").alias("key")).dropDuplicates(["id", "key"])
    asked = store(asked, "queries")
    groups = 1 + asked.count() // QUERIES
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id", "key"), F.lit(int(groups))).cast("int"))
    # One row per block and dimension reaches the driver, and one matrix per task.
    reach = placed.groupBy("dim", "block").agg(F.max("length").alias("most"))
    reach = store(reach, "reach")
    turns = _rotations(base, sorted(r["dim"] for r in reach.select("dim").distinct().collect()))
    drop(base)
    shared = vectors.sparkSession.sparkContext.broadcast(turns)
    first = reach.groupBy("dim").agg(F.max_by("block", "most").alias("block"))
    start = asked.withColumn("least", F.lit(None).cast("bigint"))
    found = store(_meet(placed.join(F.broadcast(first), ["dim", "block"]), start.join(F.broadcast(first), "dim"), k, shared, groups), "found")
    bound = found.groupBy("qid", "key").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(f"n = {int(k)}")
    known = asked.join(bound.select(F.col("qid").alias("id"), "key", "least"), ["id", "key"], "left")
    rest = reach.join(first.withColumnRenamed("block", "_b"), "dim").where("block <> _b").drop("_b")
    sent = known.join(F.broadcast(rest), "dim").where("least IS NULL OR length * most * 1.000001D + 1 >= least").drop("most")
    more = _meet(placed.join(F.broadcast(rest.select("dim", "block")), ["dim", "block"]), sent, k, shared, groups)
    order = Window.partitionBy("qid", "key").orderBy(F.desc("score"), "id")
    best = found.unionByName(more).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    fits = F.when(F.col("score").isin(*map(int, ENDS)), F.raise_error(F.lit("a score does not fit a long")).cast("bigint")).otherwise(F.col("score"))
    return best.select(F.col("qid").alias("query_id"), "rank", F.col("id").alias("vec_id"), fits.alias("score"))


def _rotations(base: DataFrame, dims: list[int]) -> dict[int, np.ndarray]:
    """By dimension, singular vectors by falling weight, as columns; the identity for very long vectors."""
    turned = [d for d in dims if 1 < d <= ROTATED]

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            size = batch.column(0).value_lengths().to_numpy()
            for d in np.unique(size).tolist():
                if d in turned:
                    x = _matrix(batch.column(0).filter(pa.array(size == d)), d)
                    total[d] = total.get(d, 0.0) + x.T @ x
        yield from total.items()
    sums = folded(base.select("v"), gram, np.add)
    return {d: np.ascontiguousarray(np.linalg.eigh(sums[d])[1][:, ::-1]) if d in turned else np.eye(max(d, 1))[:d, :d] for d in dims}


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _meet(candidates: DataFrame, sent: DataFrame, k: int, shared, groups: int) -> DataFrame:
    """Best k per query of each pair of blocks."""
    spread = candidates.select("dim", "block", "id", "v", "length").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(int(groups) - 1))))
    asked = sent.select("dim", "block", "part", F.col("id").alias("qid"), "key", "v", "length", "least")

    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        turn = shared.value[int(key[0])]
        if not len(queries) or not len(rows):
            return pd.DataFrame({"qid": [], "key": [], "id": [], "score": []}).astype("int64")
        rows = rows.sort_values(["length", "id"], ascending=[False, True], kind="stable")
        q, x = (np.stack(f["v"].to_numpy()) for f in (queries, rows))
        least = queries["least"].to_numpy(float, na_value=np.nan)
        return _block(queries["qid"].to_numpy(), queries["key"].to_numpy(), q, np.where(np.isnan(least), -np.inf, least), rows["id"].to_numpy(), x, turn, k)

    keys = ["dim", "block", "part"]
    return asked.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(run, "qid bigint, key bigint, id bigint, score bigint")


def _products(q: np.ndarray, x: np.ndarray):
    """Exact products of one query with some candidates: in doubles, longs or whole numbers of any size."""
    most = q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0))
    if most < FLOAT_EXACT:
        return lambda i, at: (x[at] @ q[i]).astype(np.int64)
    if max(most, float(np.abs(q).max(initial=0)), float(np.abs(x).max(initial=0))) < LONG:
        whole_q, whole_x = q.astype(np.int64), x.astype(np.int64)
        return lambda i, at: whole_x[at] @ whole_q[i]

    def wide(i: int, at: np.ndarray) -> np.ndarray:
        asked = [int(c) for c in q[i]]
        each = [sum(a * int(c) for a, c in zip(asked, row, strict=True)) for row in x[at]]
        return np.array([min(max(s, ENDS[0]), ENDS[1]) for s in each], np.int64)
    return wide


def _block(qid, key, q, least, ids, x, turn, k) -> pd.DataFrame:
    """Best k of sorted candidates ``x`` for each query, passing over what the bounds exclude."""
    qf, xf = q @ turn, x @ turn
    head = max(1, q.shape[1] // HEAD)
    ql, xl = np.linalg.norm(qf, axis=1), np.linalg.norm(xf, axis=1)
    qr, xr = np.linalg.norm(qf[:, head:], axis=1), np.linalg.norm(xf[:, head:], axis=1)
    product = _products(q, x)
    best_id, best = np.full((len(q), k), np.iinfo(np.int64).max), np.full((len(q), k), np.iinfo(np.int64).min)
    filled = np.zeros(len(q), np.int64)
    for lo in range(0, len(x), CHUNK):
        hi = min(lo + CHUNK, len(x))
        slack = 1.0 + 1e-6 * ql * xl[lo]
        going = np.flatnonzero(ql * xl[lo] + slack >= least)
        if not len(going):
            break
        bound = qf[going, :head] @ xf[lo:hi, :head].T + np.outer(qr[going], xr[lo:hi]) + slack[going, None]
        able = (bound >= least[going, None]) & (ids[lo:hi] != qid[going, None])
        for row, i in zip(able, going, strict=True):
            at = np.flatnonzero(row) + lo
            if not len(at):
                continue
            score = product(i, at)
            all_ids = np.concatenate([best_id[i, : filled[i]], ids[at]])
            scores = np.concatenate([best[i, : filled[i]], score])
            order = np.lexsort((all_ids, -scores))[:k]
            filled[i] = len(order)
            best_id[i, : len(order)], best[i, : len(order)] = all_ids[order], scores[order]
            if len(order) == k:
                least[i] = max(least[i], float(scores[order[-1]]))
    keep = np.arange(k) < filled[:, None]
    return pd.DataFrame({"qid": np.repeat(qid, filled), "key": np.repeat(key, filled), "id": best_id[keep], "score": best[keep]})
