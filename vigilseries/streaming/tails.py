"""The newest rows of every series, kept in Spark's own state store.

Rows travel and rest as Arrow messages, so every type survives unchanged. Each
input partition first reduces its rows to the newest of each series; the task
that keeps a series then sees one message per partition of it, however many
rows the series has in the batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

KEY = "_key"
TIE = "_tie"
TIME = "_time"
NEW = "_new"
PACKED = "_packed"
HELD_ROWS = 65_536
#: Messages packed and passed on at a time: each costs some kilobytes while it is made, whatever it holds.
MESSAGES = 1_024
_MESSAGE = f"{KEY} string, {PACKED} binary"


def newest(table: pa.Table, order: Sequence[str], keep: int) -> pa.Table:
    """The last ``keep`` rows of each key in ``order``, nulls first, sorted by key and order."""
    if table.num_rows == 0:
        return table
    places = pc.sort_indices(table, [(c, "ascending") for c in (KEY, *order)], null_placement="at_start")
    table = table.take(places).combine_chunks()
    codes = pc.dictionary_encode(table[KEY]).combine_chunks().indices.to_numpy()
    ends = np.append(np.flatnonzero(np.diff(codes)), len(codes) - 1)
    last = np.repeat(ends, np.diff(ends, prepend=-1))
    return table.filter(pa.array(last - np.arange(len(codes)) < keep))


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpack(message: bytes) -> pa.Table:
    return pa.ipc.open_stream(message).read_all()


def _messages(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """One message per key of a table sorted by key, with its newest time if rows have ``_time``."""
    keys = table[KEY].combine_chunks()
    codes = pc.dictionary_encode(keys).indices.to_numpy()
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    ends = np.append(starts[1:], len(codes))
    for at in range(0, len(starts), MESSAGES):
        some, until = starts[at: at + MESSAGES], ends[at: at + MESSAGES]
        packed = pa.array([pack(table.slice(a, b - a)) for a, b in zip(some, until, strict=True)], pa.binary())
        out = {KEY: keys.take(pa.array(some)).cast(pa.string()), PACKED: packed}
        if TIME in table.column_names:
            out[TIME] = pa.array([pc.max(table[TIME].slice(a, b - a)).as_py() for a, b in zip(some, until, strict=True)], table.schema.field(TIME).type)
        yield pa.record_batch(out)


def _reducer(order: Sequence[str], keep: int):
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = newest(table if held is None else pa.concat_tables([held, table]), order, keep)
            if held.num_rows > HELD_ROWS:
                yield from _messages(held)
                held = None
        if held is not None and held.num_rows:
            yield from _messages(held)
    return reduce


def _keeper(order: Sequence[str], keep: int, ttl_ms: int | None):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        mark = state.getCurrentWatermarkMs() if ttl_ms is not None else None
        tail = kept = None
        if state.exists:
            kept = bytes(state.get[0])
            tail = unpack(kept)
            if ttl_ms is not None and _last_ms(tail) + ttl_ms <= mark:
                kept = tail = None
        for messages in batches:
            parts = [unpack(m) for m in messages[PACKED]]
            tail = newest(pa.concat_tables(parts if tail is None else [tail, *parts]), order, keep)
        if kept is not None:
            yield pd.DataFrame({KEY: [key[0]], PACKED: [kept]})
        if ttl_ms is None:
            state.update((pack(tail),))
        elif _last_ms(tail) + ttl_ms > mark:
            state.update((pack(tail),))
            state.setTimeoutTimestamp(_last_ms(tail) + ttl_ms)
        elif state.exists:
            state.remove()
    return step


def _last_ms(tail: pa.Table) -> int:
    """Newest time in milliseconds; rows without a time are as old as can be."""
    last = pc.max(tail[TIME]).cast(pa.timestamp("ms", tz="UTC"), safe=False)
    return last.value if last.is_valid else 0


def earlier_tails(rows: DataFrame, order: Sequence[str], keep: int, lateness: str | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Streaming: per series of a batch, the message of the rows kept before it, and the new ones kept in their place.

    ``rows`` carries the series key in ``_key``. Only series with rows in the
    batch are read or written. With ``ttl_ms`` rows carry ``_time``; a series
    whose newest row is that much older than the watermark is forgotten, and
    messages before the watermark neither read nor change what is kept.
    """
    timed = ttl_ms is not None
    messages = rows.mapInArrow(_reducer(order, keep), f"{_MESSAGE}, {TIME} timestamp" if timed else _MESSAGE)
    if timed:
        messages = messages.withWatermark(TIME, lateness)
    return messages.groupBy(KEY).applyInPandasWithState(
        _keeper(order, keep, ttl_ms), _MESSAGE, "tail binary", "append",
        GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.NoTimeout)


def opened(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of messages."""
    names = schema.fieldNames()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for message in batch.column(0):
                yield from unpack(message.as_py()).select(names).to_batches()
    return messages.select(PACKED).mapInArrow(rows, schema)


def series_name(series: Sequence[str]):
    """One never-null text per series; a null part differs from every value."""
    return F.to_json(F.struct(*series)) if series else F.lit("")
