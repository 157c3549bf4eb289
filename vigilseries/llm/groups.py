"""Whole groups out of Arrow batches that arrive sorted by key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Yield tables of complete groups and the offsets of the groups in them.

    The rows must be sorted by ``keys`` (without nulls), and each key must be in
    one partition. Only the last, unfinished group of a batch is carried over.
    """
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        new = _changes(table, keys)
        head = tuple(table.column(k)[0].as_py() for k in keys)
        if last is not None and head == last:
            new[0] = False
        starts = np.flatnonzero(new)
        last = tuple(table.column(k)[table.num_rows - 1].as_py() for k in keys)
        if len(starts) == 0:
            held.append(table)
            continue
        done = pa.concat_tables([*held, table.slice(0, int(starts[-1]))]) if held or starts[-1] else None
        if done is not None and done.num_rows:
            yield _closed(done, keys)
        held = [table.slice(int(starts[-1]))]
    if held:
        yield _closed(pa.concat_tables(held), keys)


def _closed(table: pa.Table, keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    table = table.combine_chunks()
    return table, np.append(np.flatnonzero(_changes(table, keys)), table.num_rows)


def _changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        column = table.column(k).combine_chunks()
        if pa.types.is_binary(column.type) or pa.types.is_string(column.type) or pa.types.is_large_binary(column.type):
            column = column.dictionary_encode()
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            values = column.indices.to_numpy(zero_copy_only=False)
        else:
            values = column.to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return new


def fixed_bytes(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """A binary column of equally long values as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1)
