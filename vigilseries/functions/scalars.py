"""Column expressions for dates, scores, numbers and log text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anomaly type of a telemetry row -> root-cause category of its logs.
CATEGORY_OF_ANOMALY = {
    "latency_spike": "timeout",
    "packet_loss_burst": "packet_loss",
    "throughput_drop": "congestion",
    "handover_storm": "handover_fail",
    "signal_degradation": "signal_degradation",
    "cpu_overload": "cpu_overload",
    "none": "normal",
}
NORMAL = "normal"
LOG_SEPARATOR = " | "
LOG_TIME = "yyyy-MM-dd'T'HH:mm:ss"


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def weekday_of(ts: Column) -> Column:
    """0 = Monday."""
    return F.weekday(ts)


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def binarize_score(score: Column, threshold: float | Column) -> Column:
    """1 where the score reaches the threshold (inclusive)."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= limit).cast("int")


def round4(x: Column) -> Column:
    return F.round(x, 4)


def truncate_doc(text: Column, n: int = 200) -> Column:
    return F.substring(text, 1, n)


def category_map(anomaly_type: Column, is_anomaly: Column | None = None, mapping: dict[str, str] | None = None) -> Column:
    """Root-cause category; unknown types and non-anomalous rows are ``normal``."""
    pairs = [F.lit(x) for kv in (mapping or CATEGORY_OF_ANOMALY).items() for x in kv]
    found = F.coalesce(F.try_element_at(F.create_map(*pairs), anomaly_type), F.lit(NORMAL))
    return found if is_anomaly is None else F.when(is_anomaly == 1, found).otherwise(F.lit(NORMAL))


def log_line_format(ts: Column, severity: Column, code: Column, message: Column) -> Column:
    return F.concat_ws(LOG_SEPARATOR, F.date_format(ts, LOG_TIME), severity, code, message)


def log_line_parse(line: Column) -> dict[str, Column]:
    """The four fields of a log line; a malformed line gives nulls and keeps its row."""
    parts = F.split(line, r" \| ", 4)
    ok = F.size(parts) == 4
    return {
        "log_ts": F.when(ok, F.try_to_timestamp(parts[0], F.lit(LOG_TIME))),
        "severity": F.when(ok, F.get(parts, 1)),
        "error_code": F.when(ok, F.get(parts, 2)),
        "message": F.when(ok, F.get(parts, 3)),
    }


def missing_if_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def stable_hash(key: Column, seed: int) -> Column:
    """Hex digest that orders keys the same way in any SQL engine."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
