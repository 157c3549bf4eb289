"""Rolling, lag, difference and calendar features over row frames."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilseries.functions.scalars import cyclic, hour_of, weekday_of
from vigilseries.operators.layout import (
    CHUNK, ROW_IDX, chunk_over, drop_halo, ensure_index, group_of, series_key, with_halo,
)
from vigilseries.operators.missing import ffill_zero
from vigilseries.operators.rows import drop_warmup
from vigilseries.operators.sliding import helpers, sliding, stats
from vigilseries.session import materialize

ROLLING_WINDOWS = (5, 15, 30)
LAG_STEPS = (1, 5, 15, 30)


def _framed(df: DataFrame, order_col, series_cols, chunk, before: int, build) -> DataFrame:
    """Run ``build(frame, window text)`` inside halo chunks."""
    keys = series_key(series_cols)
    spread = with_halo(ensure_index(df, order_col, series_cols), keys, before, rows=chunk)
    return drop_halo(build(spread, chunk_over(keys)), rows=chunk)


def _rolling(metrics, windows) -> list[str]:
    return stats(metrics, windows, ("mean", "std", "min", "max"), "{m}_{kind}_{w}")


def _lags(metrics, steps, over: str) -> list[str]:
    return [f"lag(`{m}`, {k}) OVER ({over}) AS `{m}_lag_{k}`" for m in metrics for k in steps]


def _diffs(metrics, over: str) -> list[str]:
    return [f"coalesce(`{m}` - lag(`{m}`, 1) OVER ({over}), 0.0D) AS `{m}_roc`" for m in metrics]


def rolling_stats(df: DataFrame, metrics: Sequence[str], order_col, windows: Sequence[int] = ROLLING_WINDOWS,
                  series_cols=None, chunk: int | None = None) -> DataFrame:
    """Mean, sample std (0 where undefined), min and max over the last w rows."""
    def build(spread, over):
        return sliding(spread, metrics, windows, over).selectExpr("*", *_rolling(metrics, windows)).drop(*helpers(metrics, windows))
    return _framed(df, order_col, series_cols, chunk, max(windows) - 1, build)


def rolling_mean_std(df: DataFrame, metrics: Sequence[str], order_col, window: int = 15, series_cols=None,
                     chunk: int | None = None) -> DataFrame:
    """Mean and std over the last ``window`` rows; metrics the table lacks are skipped."""
    present = [m for m in metrics if m in df.columns]

    def build(spread, over):
        rolled = sliding(spread, present, [window], over, extremes=False)
        return rolled.selectExpr("*", *stats(present, [window], ("mean", "std"), "{m}_roll_{kind}_{w}")).drop(*helpers(present, [window]))
    return _framed(df, order_col, series_cols, chunk, window - 1, build)


def rolling_mean_std_valid(df: DataFrame, metrics: Sequence[str], order_col, window: int = 15, series_cols=None,
                           chunk: int | None = None) -> DataFrame:
    """Mean and std over the last ``window`` values present.

    Missing rows (null or NaN) use no slot and repeat the current statistics;
    before the first value both are 0.0. A chunk needs only the last ``window``
    values before it: each chunk gives its own last values, these are passed
    along the chunks (in two levels), and every chunk is then worked through as
    arrays. The rows are shuffled twice: once for the summary, once to meet it.
    """
    present = [m for m in metrics if m in df.columns]
    indexed = ensure_index(df, order_col, series_cols)
    keys = series_key(series_cols)
    placed = indexed.withColumn(CHUNK, group_of(ROW_IDX, chunk))
    tails = placed.groupBy(*keys, CHUNK).agg(*[_last_values(m, window).alias(m) for m in present])
    before = values_before(materialize(tails, "tails"), present, window, CHUNK, keys, chunk)
    names = [f"{m}_roll_{s}_{window}" for m in present for s in ("mean", "std")]
    schema = T.StructType([*indexed.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    columns = indexed.columns

    def run(rows: pa.Table, held: pa.Table) -> pa.Table:
        rows = rows.sort_by(ROW_IDX)
        out = {}
        for m in present:
            values = rows.column(m).cast(pa.float64()).to_numpy()
            known = held.column(m)[0].as_py() if held.num_rows else None
            out[m] = rolled_valid(values, np.array(known or [], float), window)
        added = [pa.array(out[m][k]) for m in present for k in (0, 1)]
        return pa.Table.from_arrays([*[rows.column(c) for c in columns], *added], schema=pa.schema([*[rows.schema.field(c) for c in columns], *[pa.field(n, pa.float64()) for n in names]]))

    spread = [*keys, CHUNK]
    return placed.groupBy(*spread).cogroup(before.groupBy(*spread)).applyInArrow(run, schema)


def _last_values(m: str, window: int):
    """The last values present of a chunk, in row order."""
    there = F.col(m).isNotNull() & ~F.isnan(F.col(m).cast("double"))
    each = F.array_sort(F.collect_list(F.when(there, F.struct(F.col(ROW_IDX).alias("i"), F.col(m).cast("double").alias("v")))))
    return F.reverse(F.slice(F.reverse(F.transform(each, lambda e: e["v"])), 1, window))


def values_before(tails: DataFrame, metrics: Sequence[str], window: int, idx: str, keys: Sequence[str], rows: int | None,
                  levels: int = 1) -> DataFrame:
    """For each summary row, per metric the last ``window`` values of all rows before it in its series."""
    group = "_above"
    if levels:
        grouped = tails.withColumn(group, group_of(idx, rows))
        joined = [F.reverse(F.slice(F.reverse(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), F.col(m).alias("v")))), lambda e: e["v"]))), 1, window)).alias(m)
                  for m in metrics]
        above = values_before(grouped.groupBy(*keys, group).agg(*joined), metrics, window, group, keys, rows, levels - 1)
    else:
        grouped = tails.withColumn(group, F.lit(0).cast("bigint"))
        above = grouped.groupBy(*keys, group).agg(*[F.array().cast("array<double>").alias(m) for m in metrics])
    kind = grouped.schema[idx].dataType
    fields = [*[grouped.schema[k] for k in keys], T.StructField(idx, kind), *[T.StructField(m, T.ArrayType(T.DoubleType())) for m in metrics]]

    def run(own: pa.Table, start: pa.Table) -> pa.Table:
        own = own.sort_by(idx)
        out = {k: own.column(k).to_pylist() for k in [*keys, idx]}
        for m in metrics:
            state, lists = list(start.column(m)[0].as_py() or []) if start.num_rows else [], []
            for values in own.column(m).to_pylist():
                lists.append(state)
                state = [*state, *(values or [])][-window:]
            out[m] = lists
        return pa.table({k: pa.array(v, pa.list_(pa.float64())) if k in metrics else pa.array(v) for k, v in out.items()})

    spread = [*keys, group]
    return grouped.groupBy(*spread).cogroup(above.groupBy(*spread)).applyInArrow(run, T.StructType(fields))


def rolled_valid(values: np.ndarray, before: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and std (ddof 1, 0.0 where undefined) over the last values present, given those before."""
    there = ~np.isnan(values)
    known = np.concatenate([np.full(window, np.nan), before, values[there]])
    frames = np.lib.stride_tricks.sliding_window_view(known, window)[1:]
    n = (~np.isnan(frames)).sum(axis=1)
    mean = np.nansum(frames, axis=1) / np.maximum(n, 1)
    spread = np.where(np.isnan(frames), 0.0, frames - mean[:, None])
    std = np.sqrt((spread * spread).sum(axis=1) / np.maximum(n - 1, 1))
    at = np.cumsum(there) + len(before) - 1
    if not len(mean):
        return np.zeros(len(values)), np.zeros(len(values))
    found, at = at >= 0, np.maximum(at, 0)
    return np.where(found, mean[at], 0.0), np.where(found & (n[at] > 1), std[at], 0.0)


def lag_features(df: DataFrame, metrics: Sequence[str], order_col, steps: Sequence[int] = LAG_STEPS, series_cols=None,
                 chunk: int | None = None) -> DataFrame:
    """Values k rows earlier, null at the start of a series."""
    return _framed(df, order_col, series_cols, chunk, max(steps), lambda spread, over: spread.selectExpr("*", *_lags(metrics, steps, over)))


def rate_of_change(df: DataFrame, metrics: Sequence[str], order_col, series_cols=None, chunk: int | None = None) -> DataFrame:
    """Difference from the previous row, 0.0 where undefined."""
    return _framed(df, order_col, series_cols, chunk, 1, lambda spread, over: spread.selectExpr("*", *_diffs(metrics, over)))


def time_parts(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    ts = F.col(ts_col)
    return df.select("*", hour_of(ts).alias("hour"), weekday_of(ts).alias("weekday"), F.date_format(ts, "EEEE").alias("day_name"))


def time_features(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Hour and weekday on the unit circle, and a weekend flag."""
    hour_sin, hour_cos = cyclic(hour_of(F.col(ts_col)), 24)
    dow = weekday_of(F.col(ts_col))
    dow_sin, dow_cos = cyclic(dow, 7)
    return df.select(
        "*", hour_sin.alias("hour_sin"), hour_cos.alias("hour_cos"), dow_sin.alias("dow_sin"), dow_cos.alias("dow_cos"),
        (dow >= 5).cast("int").alias("is_weekend"))


def build_features(df: DataFrame, metrics: Sequence[str], order_col, drop_rows: int = 30, series_cols=None,
                   chunk: int | None = None, ts_col: str = "timestamp", windows: Sequence[int] = ROLLING_WINDOWS,
                   steps: Sequence[int] = LAG_STEPS, dense: bool = False) -> DataFrame:
    """All features over one window layout, warm-up rows dropped, gaps filled.

    ``dense`` says the metrics were imputed. A feature is then undefined only
    in a whole series or at its start, where the forward fill finds nothing, so
    0.0 alone gives the same answer without another shuffle.
    """
    reach = max(max(windows) - 1, max(steps))

    def build(spread, over):
        return sliding(spread, metrics, windows, over).selectExpr(
            "*", *_rolling(metrics, windows), *_lags(metrics, steps, over), *_diffs(metrics, over)).drop(*helpers(metrics, windows))

    out = drop_warmup(time_features(_framed(df, order_col, series_cols, chunk, reach, build), ts_col), drop_rows)
    fill = [*metrics, *[f"{m}_{s}_{n}" for m in metrics for n in windows for s in ("mean", "min", "max")],
            *[f"{m}_lag_{k}" for m in metrics for k in steps]]
    if dense:
        filled = set(fill)
        return out.selectExpr(*[f"coalesce(`{c}`, 0.0D) AS `{c}`" if c in filled else f"`{c}`" for c in out.columns])
    return ffill_zero(materialize(out, "features"), fill, order_col, series_cols, chunk)
