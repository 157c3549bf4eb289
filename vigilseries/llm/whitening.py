"""Embedding whitening: blockwise QR of the centred rows, then a bidiagonal qd solver for the small factor.

Every task reduces its centred rows block by block to one triangular factor;
factors are stacked and reduced in groups until one is left, so the
covariance matrix is never formed and its rounding never enters. Householder
reflections make that factor bidiagonal, dqds finds its singular values and
twisted factorisations its right singular vectors: the whitening directions.
Only one factor (dimension x dimension) reaches the driver.

Integer components and their exact sums decide the mean; rows are centred as
(n * x - sum) / n with an exact numerator.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.bidiagonal import right_singular
from vigilseries.llm.fold import folded

SCALE, LIFT = 64, 1_000_000
BLOCK = 4096
COMPONENTS = 32


@dataclass
class Whitening:
    """Row count, exact sums, directions (one column per component) and their variances, and the total variance."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sum`` in whole numbers."""
        reach = self.n * int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0))
        if reach >= 1 << 63:
            return x.astype(object) * self.n - self.sums.astype(object)
        return x * self.n - self.sums

    def project(self, x: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
        """Whitened components and the exact squared length of ``n * x - sum`` of each row."""
        apart = self.centred(x)
        whitened = (apart.astype(float) / self.n) @ (self.directions / np.sqrt(self.variances))
        if apart.dtype != object and x.shape[1] * int(np.abs(apart).max(initial=0)) ** 2 < 1 << 63:
            return whitened, (apart * apart).sum(1)
        return whitened, [sum(int(v) * int(v) for v in row) for row in apart]


def integer_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, x)`` with x = floor(64 * component) + 1000000.

    Left out: null and empty vectors and those with a null or non-finite
    component. A component beyond 2**53 after scaling is an error. A null id is kept.
    """
    scaled = F.transform(F.col(vector_col), lambda c: c.cast("double") * SCALE)
    rows = df.select(F.col(id_col).alias("id"), scaled.alias("v")).where("v IS NOT NULL AND size(v) > 0")
    rows = rows.where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    whole = F.transform("v", lambda c: F.when(F.abs(c) < float(1 << 53), F.floor(c) + LIFT).otherwise(F.raise_error(F.lit("component too large")).cast("bigint")))
    return rows.select("id", whole.alias("x"))


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all ``(id, x)`` rows; None without rows. Directions without variance are left out. All vectors must be equally long."""
    facts = rows.select(F.size("x").alias("d")).agg(F.count(F.lit(1)), F.min("d"), F.max("d")).first()
    n, shortest, dim = facts
    if not n:
        return None
    if shortest != dim:
        raise ValueError(f"vectors of {shortest} and of {dim} components cannot be whitened together")
    # One row per task and dimension is summed; ``dim`` sums reach the driver.
    parts = rows.select("x").mapInArrow(_summer(dim), "at int, s bigint").groupBy("at").agg(F.sum("s").alias("s")).collect()
    sums = np.zeros(dim, np.int64)
    for r in parts:
        sums[r["at"]] = r["s"]
    model = Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0)
    factor = _reduced(rows, lambda x: model.centred(x).astype(float) / n, _qr, dim)
    values, vectors = right_singular(factor)
    variances = values / n
    model.total = float((factor * factor).sum() / n)
    use = min(components, int((variances > dim * np.finfo(float).eps * max(variances[0], 0.0)).sum()))
    model.directions, model.variances = vectors[:, :use], variances[:use]
    return model


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry, without sign, of the whitened rows' covariance minus the identity."""
    k = len(model.variances)
    if not k:
        return 0.0

    def moments(total: np.ndarray, w: np.ndarray) -> np.ndarray:
        return total + w.T @ w
    # The mean is 0 by construction (the numerators sum to 0); a column of ones measures what rounding leaves of it.
    both = _reduced(rows, lambda x: np.hstack([model.project(x)[0], np.ones((len(x), 1))]), moments, k + 1, np.add)
    mean = both[:k, k] / model.n
    return float(np.abs(both[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` for every row and component.

    Left out: null and empty vectors and those with a null or non-finite
    component, and components without variance (all of them for a single row or
    equal rows). Rows with a null id are fitted and returned; rows that repeat
    an id are rows of their own. An empty table gives no rows. Vectors of unequal
    length are an error, and so is a deviation that exceeds a long. No other
    column is read.
    """
    rows = integer_rows(df, id_col, vector_col)
    model = fit_whitening(rows, components)
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.variances):
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error = identity_error(rows, model)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.variances)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                whitened, deviation = m.project(_matrix(part.column(1)))
                each = np.repeat(np.arange(part.num_rows), k)
                size = len(each)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)), pa.array(np.full(size, m.n)),
                     pa.array(deviation, pa.int64()).take(pa.array(each)), pa.array(whitened.ravel()),
                     pa.array(np.tile(m.variances / m.total, part.num_rows)), pa.array(np.full(size, error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def whitened_vectors(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, vector)``: the whitened vectors themselves, for the rows ``whiten`` keeps."""
    rows = integer_rows(df, id_col, vector_col)
    model = fit_whitening(rows, components)
    kind = dict(rows.dtypes)["id"]
    if model is None:
        return df.sparkSession.createDataFrame([], f"id {kind}, vector array<double>").withColumnRenamed("id", id_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = shared.value.project(_matrix(batch.column(1)))[0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(made), pa.list_(pa.float64()))], ["id", "vector"])
    return rows.mapInArrow(run, f"id {kind}, vector array<double>").withColumnRenamed("id", id_col)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.int64)


def _summer(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, np.int64)
        for batch in batches:
            total += _matrix(batch.column(0)).sum(0) if batch.num_rows else 0
        yield pa.record_batch([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total)], ["at", "s"])
    return run


def _qr(factor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    r = np.linalg.qr(np.vstack([factor, rows]), mode="r")
    return np.vstack([r, np.zeros((factor.shape[1] - len(r), factor.shape[1]))])


def _reduced(rows: DataFrame, made: Callable[[np.ndarray], np.ndarray], fold: Callable[[np.ndarray, np.ndarray], np.ndarray], dim: int,
             merge: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Fold all rows, block by block, to one ``dim`` x ``dim`` matrix."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                total = fold(total, made(_matrix(batch.column(0).slice(lo, BLOCK))))
        yield 0, total
    return folded(rows.select("x"), first, merge or fold).get(0, np.zeros((dim, dim)))
