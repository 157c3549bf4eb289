"""Blended alert score and episode overlay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilseries.operators.layout import CHUNK_ROWS, ROW_IDX, as_list, ensure_index, null_safe_join


def unified_alert(scores: DataFrame, log_scores: DataFrame, on: str | Sequence[str], alpha: float = 0.7,
                  seq_col: str = "p_seq", log_col: str = "p_anomaly") -> DataFrame:
    """alpha * sequence score + (1 - alpha) * strongest log score of the step (0 without logs)."""
    keys = as_list(on)
    strongest = log_scores.groupBy(*keys).agg(F.max(log_col).alias("p_knn"))
    joined = null_safe_join(scores, strongest, keys, "left").withColumn("p_knn", F.coalesce("p_knn", F.lit(0.0)))
    return joined.withColumn("alert_score", F.lit(alpha) * F.col(seq_col) + F.lit(1.0 - alpha) * F.col("p_knn"))


def overlay_episodes(df: DataFrame, episodes: DataFrame, order_col, metrics: Sequence[str], series_cols=None,
                     class_col: str = "is_anomaly", type_col: str = "anomaly_type") -> DataFrame:
    """Apply episodes (start_idx, length, ord, kind, metric, op, value, lo, hi) to a series.

    An episode covers ``length + 1`` rows. ``op`` is ``multiply`` (then clipped
    to lo..hi where given) or ``set``; episodes on one row apply by (ord, start_idx)
    and the last one names the row. Long episodes are first cut at chunk borders
    so that no task expands more than one chunk of an episode at a time.
    """
    series = as_list(series_cols)
    indexed = ensure_index(df, order_col, series)
    rows = F.lit(CHUNK_ROWS)
    end = F.col("start_idx") + F.col("length")
    first, last = F.floor(F.col("start_idx") / rows), F.floor(end / rows)
    pieces = episodes.withColumn("_c", F.explode(F.sequence(first, last))).repartition("_c", "start_idx", "ord")
    touched = pieces.withColumn(ROW_IDX, F.explode(F.sequence(
        F.greatest(F.col("start_idx"), F.col("_c") * rows).cast("bigint"),
        F.least(end, (F.col("_c") + 1) * rows - 1).cast("bigint"))))
    op = F.struct("ord", "start_idx", "kind", "metric", "op", F.col("value").cast("double").alias("value"),
                  F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"))
    per_row = touched.groupBy(*series, ROW_IDX).agg(F.array_sort(F.collect_list(op)).alias("_ops"))
    joined = null_safe_join(indexed, per_row, [*series, ROW_IDX], "left")

    def apply(v, o):
        scaled = v * o["value"]
        scaled = F.when(o["lo"].isNotNull(), F.greatest(scaled, o["lo"])).otherwise(scaled)
        scaled = F.when(o["hi"].isNotNull(), F.least(scaled, o["hi"])).otherwise(scaled)
        return F.when(o["op"] == "set", o["value"]).when(v.isNotNull(), scaled)

    def of(metric):
        return lambda o: o["metric"] == metric

    hit = F.col("_ops").isNotNull()
    changed = {
        m: F.when(hit, F.aggregate(F.filter("_ops", of(m)), F.col(m).cast("double"), apply)).otherwise(F.col(m).cast("double"))
        for m in metrics}
    return joined.withColumns({
        **changed,
        class_col: F.when(hit, F.lit(1)).otherwise(F.col(class_col)),
        type_col: F.when(hit, F.element_at("_ops", -1)["kind"]).otherwise(F.col(type_col)),
    }).drop("_ops")
