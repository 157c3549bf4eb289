"""Chronological splits, scaling and sliding sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilseries.operators.layout import (
    CHUNK, ROW_IDX, attach, chunk_over, chunk_window, drop_halo, ensure_index, series_key, series_length, with_halo,
)


def chronological_split(df: DataFrame, order_col, train_frac: float = 0.70, val_frac: float = 0.15, series_cols=None) -> DataFrame:
    """Add ``split``: the first rows train, the next val, the rest test."""
    indexed = ensure_index(df, order_col, series_cols)
    n = F.col("_n")
    n_train, n_val = (F.floor(n * F.lit(float(f))).cast("bigint") for f in (train_frac, val_frac))
    split = F.when(F.col(ROW_IDX) < n_train, "train").when(F.col(ROW_IDX) < n_train + n_val, "val").otherwise("test")
    keys = series_key(series_cols)
    return attach(indexed, series_length(indexed, keys), keys).withColumn("split", split).drop("_n")


def split_summary(df: DataFrame, class_col: str = "is_anomaly") -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.avg(class_col).alias("anomaly_rate"))


def class_weight(df: DataFrame, class_col: str = "is_anomaly") -> DataFrame:
    """Negatives per positive (never dividing by less than 1)."""
    pos, n = F.coalesce(F.sum(class_col), F.lit(0)), F.count(F.lit(1))
    return df.agg(pos.cast("bigint").alias("n_pos"), (n - pos).cast("bigint").alias("n_neg"),
                  ((n - pos) / F.greatest(pos, F.lit(1))).cast("double").alias("pos_weight"))


def fit_scaler(df_train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, mean, scale) with population std; a constant column gets scale 1."""
    stats = df_train.agg(*[
        F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("scale")).alias(f"s{i}")
        for i, c in enumerate(cols)])
    rows = stats.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))])))
    return rows.withColumn("scale", F.when(F.col("scale") > 0, F.col("scale")).otherwise(F.lit(1.0)))


def scaler_values(params: DataFrame) -> list[tuple[str, float, float]]:
    """The fitted values; one row per feature, so the schema bounds them."""
    return [(r["feature"], r["mean"], r["scale"]) for r in params.collect()]


def apply_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    """(x - mean) / scale, with the fitted values inlined so that no join is needed."""
    return df.withColumns({f: (F.col(f) - F.lit(m)) / F.lit(s) for f, m, s in scaler_values(params)})


def sliding_sequences(df: DataFrame, feature_cols: Sequence[str], label_col: str, order_col, window: int = 30,
                      include_last: bool = False, group_cols: Sequence[str] = ("split",), series_cols=None,
                      chunk: int | None = None) -> DataFrame:
    """One row per window: ``features`` holds ``window`` vectors, ``label`` is the one at its end.

    Windows never cross a group. The last window of a group is left out unless
    ``include_last``.
    """
    groups, placed = place_rows(df, feature_cols, label_col, order_col, group_cols, series_cols, lambda x: [F.array(*x.values()).alias("_x")])
    frame = chunk_window(groups, "_pos").rowsBetween(-(window - 1), 0)
    seq = with_halo(placed, groups, window - 1, rows=chunk, idx="_pos").withColumn("features", F.collect_list("_x").over(frame))
    return _complete(seq, groups, window, include_last, chunk)


def window_summaries(df: DataFrame, feature_cols: Sequence[str], label_col: str, order_col, window: int = 30,
                     include_last: bool = False, group_cols: Sequence[str] = ("split",), series_cols=None,
                     chunk: int | None = None) -> DataFrame:
    """The windows of ``sliding_sequences`` as one vector each: the newest step, then the mean step.

    Keeps 2 values per feature and row instead of ``window``. Means are
    differences of chunk-local running sums; features must not be null.
    """
    groups, placed = place_rows(df, feature_cols, label_col, order_col, group_cols, series_cols, lambda x: [c.alias(f"_x{i}") for i, c in enumerate(x.values())])
    spread, over, n = with_halo(placed, groups, window, rows=chunk, idx="_pos"), chunk_over(groups, "_pos"), len(feature_cols)
    summed = spread.selectExpr("*", *[f"sum(_x{i}) OVER ({over} ROWS UNBOUNDED PRECEDING) AS _s{i}" for i in range(n)])
    older = summed.selectExpr("*", *[f"lag(_s{i}, {window}) OVER ({over}) AS _o{i}" for i in range(n)])
    means = [f"(_s{i} - coalesce(_o{i}, 0.0D)) / {window}" for i in range(n)]
    ready = older.selectExpr(*groups, ROW_IDX, "_pos", "_n", "label", CHUNK, f"array({', '.join([*[f'_x{i}' for i in range(n)], *means])}) AS features")
    return _complete(ready, groups, window, include_last, chunk)


def place_rows(df, feature_cols, label_col, order_col, group_cols, series_cols, columns):
    """Rows with their place ``_pos`` in their group and its size ``_n``."""
    groups = [*series_key(series_cols), *group_cols]
    indexed = ensure_index(df, order_col, series_cols)
    extent = indexed.groupBy(*groups).agg(F.min(ROW_IDX).alias("_from"), F.count(F.lit(1)).alias("_n"))
    placed = attach(indexed, extent, groups).withColumn("_pos", F.col(ROW_IDX) - F.col("_from"))
    return groups, placed.select(*groups, ROW_IDX, "_pos", "_n", F.col(label_col).alias("label"),
                                 *columns({c: F.col(c).cast("double") for c in feature_cols}))


def _complete(windows: DataFrame, groups, window: int, include_last: bool, chunk) -> DataFrame:
    last = F.col("_n") - (1 if include_last else 2)
    return drop_halo(windows, rows=chunk, idx="_pos").where(
        (F.col("_pos") >= window - 1) & (F.col("_pos") <= last)
    ).select(*groups, ROW_IDX, "features", "label")


def newest_window(df: DataFrame, feature_cols: Sequence[str], order_cols: Sequence[str], series_cols: Sequence[str],
                  window: int = 30) -> DataFrame:
    """The newest ``window`` rows of each series as one request: series, ``features``, ``error``.

    Rows beyond the window are dropped before the shuffle, so a series holding
    most of the table sends no more than the others.
    """
    newest = Window.partitionBy(*series_cols).orderBy(*[F.desc(c) for c in order_cols])
    recent = df.withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= window)
    step = F.struct((-F.col("_r")).alias("r"), F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("x"))
    told = recent.groupBy(*series_cols).agg(F.transform(F.array_sort(F.collect_list(step)), lambda e: e["x"]).alias("features"))
    return last_window(told, "features", window)


def last_window(df: DataFrame, features_col: str = "features", window: int = 30) -> DataFrame:
    """Keep the newest ``window`` steps; a shorter request gets an ``error`` and null features."""
    n = F.coalesce(F.size(features_col), F.lit(0))
    ok = n >= window
    return df.withColumns({
        features_col: F.when(ok, F.slice(features_col, -window, window)),
        "error": F.when(~ok, F.concat(F.lit(f"window needs {window} steps, request has "), n.cast("string"))),
    })
