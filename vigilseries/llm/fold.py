"""Matrices summed or otherwise folded over all tasks, in groups, so that only one of each kind reaches the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.scratch import drop, store

FAN = 64


def folded(rows: DataFrame, first: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]],
           merge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Square matrices by kind: ``first`` yields (kind, matrix) for a task's batches, ``merge`` joins two of a kind.

    Matrices are joined ``FAN`` at a time, level by level, until one of each kind
    is left. Every level is written, so a lost executor repeats its own part.
    """
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, matrix in first(batches):
            yield pa.record_batch([pa.array([kind], pa.int32()), pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary())], ["kind", "m"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for raw in pdf.sort_values("at")["m"]:
            flat = np.frombuffer(raw)
            matrix = flat.reshape(int(round(len(flat) ** 0.5)), -1)
            total = matrix if total is None else merge(total, matrix)
        return pd.DataFrame({"at": [int(pdf["at"].iloc[0]) // FAN], "kind": [int(pdf["kind"].iloc[0])], "m": [np.ascontiguousarray(total).tobytes()]})

    current = store(rows.mapInArrow(one, "kind int, m binary").select(F.spark_partition_id().cast("bigint").alias("at"), "kind", "m"), "matrices")
    while not current.groupBy("kind").count().where("count > 1").isEmpty():
        fewer = store(current.groupBy("kind", F.expr(f"at div {FAN}").alias("g")).applyInPandas(lambda pdf: join(pdf), "at bigint, kind int, m binary"), "matrices")
        drop(current)
        current = fewer
    out = {}
    for r in current.collect():
        flat = np.frombuffer(r["m"])
        out[r["kind"]] = flat.reshape(int(round(len(flat) ** 0.5)), -1)
    drop(current)
    return out
