"""Missing-value profiling and filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilseries.operators.layout import ROW_IDX, carry, ensure_index, series_key
from vigilseries.operators.rows import head_rows


def melt(df: DataFrame, metrics: Sequence[str], keep: Sequence[str] = (), name: str = "metric", value: str = "value") -> DataFrame:
    """One row per (kept columns, metric)."""
    return df.unpivot(list(keep), [F.col(m).cast("double").alias(m) for m in metrics], name, value)


def missing_profile(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Null count and percentage per metric, in one scan."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(m).isNull()).alias(m) for m in metrics])
    return counts.unpivot("_n", list(metrics), "metric", "missing").select(
        "metric", "missing", (F.col("missing") / F.col("_n") * 100).alias("missing_pct"))


def missing_mask(df: DataFrame, metrics: Sequence[str], order_col, n: int = 500) -> DataFrame:
    """0/1 missing indicators of the first ``n`` rows."""
    keys = [order_col] if isinstance(order_col, str) else list(order_col)
    return head_rows(df.select(*keys, *metrics), order_col, n).select(
        *keys, *[F.col(m).isNull().cast("int").alias(m) for m in metrics])


def impute_linear(df: DataFrame, metrics: Sequence[str], order_col, series_cols=None, chunk: int | None = None) -> DataFrame:
    """Linear interpolation by row position; the ends take the nearest value.

    A metric with no value at all in a series stays null.
    """
    indexed = ensure_index(df, order_col, series_cols)
    at = {m: f"CASE WHEN `{m}` IS NOT NULL THEN `{ROW_IDX}` END" for m in metrics}
    value = {m: f"CAST(`{m}` AS DOUBLE)" for m in metrics}
    filled = carry(
        indexed,
        {**{f"_pi_{m}": at[m] for m in metrics}, **{f"_pv_{m}": value[m] for m in metrics}},
        {**{f"_fi_{m}": at[m] for m in metrics}, **{f"_fv_{m}": value[m] for m in metrics}},
        keys=series_key(series_cols), rows=chunk,
    )
    done = {m: _between(m) for m in metrics}
    return filled.selectExpr(*[f"{done[c]} AS `{c}`" if c in done else f"`{c}`" for c in indexed.columns])


def _between(m: str) -> str:
    """The value, the point on the line between its neighbours, or the only neighbour."""
    return (f"CASE WHEN `{m}` IS NOT NULL THEN CAST(`{m}` AS DOUBLE) WHEN `_pi_{m}` IS NOT NULL AND `_fi_{m}` IS NOT NULL "
            f"THEN `_pv_{m}` + (`_fv_{m}` - `_pv_{m}`) / (`_fi_{m}` - `_pi_{m}`) * (`{ROW_IDX}` - `_pi_{m}`) "
            f"ELSE coalesce(`_pv_{m}`, `_fv_{m}`) END")


def impute_forward_linear(df: DataFrame, metrics: Sequence[str], order_col, series_cols=None, chunk: int | None = None) -> DataFrame:
    """Forward-only interpolation followed by a back fill; gives what ``impute_linear`` gives."""
    return impute_linear(df, metrics, order_col, series_cols, chunk)


def ffill_zero(df: DataFrame, cols: Sequence[str], order_col, series_cols=None, chunk: int | None = None) -> DataFrame:
    """Last known value, 0.0 before the first."""
    indexed = ensure_index(df, order_col, series_cols, dense=False)
    filled = carry(indexed, {f"_p_{c}": f"`{c}`" for c in cols}, keys=series_key(series_cols), rows=chunk)
    wanted = set(cols)
    return filled.selectExpr(*[f"coalesce(`_p_{c}`, 0.0D) AS `{c}`" if c in wanted else f"`{c}`" for c in indexed.columns])


def fill_stat_zero(x: Column) -> Column:
    """Undefined spread or difference counts as 0.0."""
    return F.coalesce(x, F.lit(0.0))
