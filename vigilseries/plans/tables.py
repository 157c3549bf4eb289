"""Telemetry, scored rows, log lines and vectors derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilseries.functions.scalars import log_line_format
from vigilseries.operators.layout import index_rows
from vigilseries.operators.missing import impute_linear
from vigilseries.sources.files import METRICS

ORDER = ["timestamp", "event_id"]
HIGH = 150.0

# Event type -> metric it reports and anomaly type it can raise.
EVENT_METRIC = {
    "click": "latency_ms",
    "error": "packet_loss_pct",
    "purchase": "throughput_mbps",
    "signup": "handover_count",
    "view": "signal_strength_dbm",
}
EVENT_ANOMALY = {
    "click": "latency_spike",
    "error": "packet_loss_burst",
    "purchase": "throughput_drop",
    "signup": "handover_storm",
    "view": "slow_page",
}


def events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def streamed(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of them."""
    schema = spark.read.parquet(f"{sf}/{table}.parquet").schema
    # A stream opens a single file only as a pattern; this one matches nothing else.
    return spark.readStream.schema(schema).parquet(f"{sf}/{table}.parque[t]")


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """Each event is one step at which one of five sensors reports; a sixth always does."""
    kinds = F.create_map(*[F.lit(x) for kv in EVENT_ANOMALY.items() for x in kv])
    bad = F.col("value") > HIGH
    return events(spark, sf).select(
        "event_id", "user_id", F.col("ts").alias("timestamp"),
        *[F.when(F.col("event_type") == e, F.col("value")).alias(m) for e, m in EVENT_METRIC.items()],
        F.regexp_extract("props", "[0-9]+", 0).try_cast("double").alias("cpu_util_pct"),
        bad.cast("int").alias("is_anomaly"),
        F.when(bad, F.try_element_at(kinds, "event_type")).otherwise(F.lit("none")).alias("anomaly_type"))


def indexed(spark: SparkSession, sf: str, by_user: bool = False) -> DataFrame:
    return index_rows(telemetry(spark, sf), ORDER, ["user_id"] if by_user else None)


def clean(spark: SparkSession, sf: str, by_user: bool = False) -> DataFrame:
    """Imputed telemetry kept to two decimals, like the sensors report."""
    filled = impute_linear(indexed(spark, sf, by_user), METRICS, ORDER, ["user_id"] if by_user else None)
    return filled.withColumns({m: F.floor(F.col(m) * 100.0 + 0.5) / 100.0 for m in METRICS})


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """A score in 0..1, a label and the label's guess for every event."""
    score = F.col("value") / (F.col("value") + 50.0)
    return events(spark, sf).select(
        "event_id", "event_type", "value", score.alias("score"), (F.col("event_type") == "error").cast("int").alias("label"),
        (score >= 0.6).cast("int").alias("pred"))


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    base = events(spark, sf).select(
        "event_id", F.col("ts").alias("timestamp"), "event_type", "value", F.upper("event_type").alias("severity"),
        F.concat(F.lit("EV_"), F.col("event_id").cast("string")).alias("error_code"), F.col("props").alias("message"))
    return base.withColumn("log_text", log_line_format(F.col("timestamp"), F.col("severity"), F.col("error_code"), F.col("message")))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Log vectors: label 0 plays ``normal``, the others are root causes."""
    label = F.col("label").cast("string")
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.when(F.col("label") == 0, F.lit("normal")).otherwise(F.concat(F.lit("cause_"), label)).alias("category"),
        F.concat(F.lit("log line "), F.col("vec_id").cast("string")).alias("log_text"),
        F.concat(F.lit("S"), label).alias("severity"), F.concat(F.lit("E"), label).alias("error_code"))


def labelled_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("text").alias("log_text"), F.concat(F.lit("quality_"), F.col("quality").cast("string")).alias("category"),
        F.col("lang").alias("severity"), F.col("source").alias("error_code"))


def document_text(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as log lines."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.select(F.col("doc_id").alias("id"), F.col("text").alias("log_text"), F.col("lang").alias("severity"), F.col("source").alias("error_code"))


def episodes(spark: SparkSession, sf: str) -> DataFrame:
    """An episode starts at every purchase above HIGH; its metric follows the digit sum of its value."""
    pick = F.floor(F.col("value")).cast("bigint")
    metric = F.element_at(F.array(*[F.lit(m) for m in METRICS]), (pick % len(METRICS) + 1).cast("int"))
    ev = events(spark, sf).where((F.col("event_type") == "purchase") & (F.col("value") > HIGH))
    return ev.select(
        F.col("event_id").alias("start_idx"), (pick % 9 + 2).alias("length"), (pick % len(METRICS)).alias("ord"),
        F.concat(F.lit("episode_"), metric).alias("kind"), metric.alias("metric"),
        F.when(pick % 2 == 0, F.lit("multiply")).otherwise(F.lit("set")).alias("op"), (F.col("value") / 25.0).alias("value"),
        F.lit(0.0).alias("lo"), F.lit(500.0).alias("hi"))
