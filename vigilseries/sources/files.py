"""Telemetry files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilseries.functions.scalars import missing_if_nan

# Metric columns of a telemetry table.
METRICS = (
    "latency_ms",
    "packet_loss_pct",
    "throughput_mbps",
    "handover_count",
    "signal_strength_dbm",
    "cpu_util_pct",
)


def read_telemetry_csv(spark: SparkSession, path: str, metrics: Sequence[str] = METRICS, ts_col: str = "timestamp",
                       int_cols: Sequence[str] = ("is_anomaly",)) -> DataFrame:
    """CSV with a header. Unreadable or empty numbers are missing, short rows are padded, extra fields dropped."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"').csv(path)
    typed = []
    for name in raw.columns:
        text, clean = F.col(f"`{name}`"), name.strip()
        if clean in metrics:
            value = missing_if_nan(F.trim(text).try_cast("double"))
        elif clean == ts_col:
            value = F.try_to_timestamp(F.trim(text))
        elif clean in int_cols:
            value = F.trim(text).try_cast("int")
        else:
            value = text
        typed.append(value.alias(clean))
    return raw.select(*typed)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a stage output; CSV carries a header."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def write_csv(df: DataFrame, path: str) -> None:
    write_table(df, path, "csv")


def write_leaderboard(board: DataFrame, path: str) -> None:
    """One small CSV file: a row per model."""
    board.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
