"""Micro-batch jobs: scoring of recent windows and log analysis."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigilseries.operators.layout import ROW_IDX, SERIES_ID, as_list, index_rows
from vigilseries.operators.neighbours import analyze_embedded
from vigilseries.operators.text import embed_text
from vigilseries.operators.windows import rolling_mean_std
from vigilseries.session import materialize
from vigilseries.streaming.tails import KEY, NEW, PACKED, TIE, TIME, earlier_tails, opened, series_name


def stream_score_windows(stream: DataFrame, out_path: str, checkpoint: str, metrics: Sequence[str], order_cols: Sequence[str],
                         series_cols: Sequence[str], scorer: Callable[[DataFrame], DataFrame], window: int = 30,
                         ttl: str | None = None, lateness: str = "0 seconds", trigger: dict | None = None) -> StreamingQuery:
    """Score each new row over the last ``window`` rows of its series.

    Spark's state store keeps the newest ``window`` rows of each series; a batch
    reads and writes only the series it has rows of. The kept rows go before the
    batch, and both run through the same chunked windows as a batch job, so a
    series that dominates a batch is split. Output is written per batch id and
    state is versioned per batch, which makes a replayed batch harmless.

    A late row is scored at its place among the rows kept and those of its
    batch; it is kept if it is among the newest ``window``, and rows scored
    before are not scored again. ``ttl`` (an interval) forgets a series whose
    newest row is that much older than the watermark, which is the newest value
    of the first order column in all earlier batches minus ``lateness``. With
    it, rows of a series that arrive in a partition wholly before the watermark
    meet the rows of their batch alone and are not kept.
    """
    series, order = as_list(series_cols), [*as_list(order_cols), TIE]
    plain = [f.name for f in stream.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = stream.withColumns({TIE: F.xxhash64(*plain), KEY: series_name(series)})
    given = T.StructType([f for f in rows.schema.fields if f.name != KEY])
    ttl_ms = None
    if ttl:
        rows = rows.withColumn(TIME, F.col(order[0]).cast("timestamp"))
        ttl_ms = stream.sparkSession.range(1).select(
            F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {ttl}"))).first()[0]
    earlier = earlier_tails(rows, order, window, lateness, ttl_ms)
    both = rows.drop(KEY, TIME).withColumn(PACKED, F.lit(None).cast("binary")).unionByName(earlier.drop(KEY), allowMissingColumns=True)

    def step(batch: DataFrame, batch_id: int) -> None:
        here = materialize(batch, "batch")  # the state is read and written once
        new, old = here.where(F.col(PACKED).isNull()).drop(PACKED), here.where(F.col(PACKED).isNotNull())
        placed = index_rows(new.withColumn(NEW, F.lit(True)).unionByName(opened(old, given).withColumn(NEW, F.lit(False))), order, series)
        recent = rolling_mean_std(placed, metrics, order, window, series)
        scorer(recent.where(NEW).drop(NEW, TIE, ROW_IDX, SERIES_ID)).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = both.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_analyze_logs(stream: DataFrame, out_path: str, checkpoint: str, train: DataFrame, store: DataFrame, encoder_model,
                        text_col: str = "log_text", id_col: str = "id", label_col: str = "category", top_k: int = 3,
                        trigger: dict | None = None) -> StreamingQuery:
    """Classify log lines as they arrive against stored vectors."""

    def step(batch: DataFrame, batch_id: int) -> None:
        coded = materialize(embed_text(batch, text_col, model=encoder_model).select(id_col, "embedding"), "batch")
        analyze_embedded(coded, train, store, label_col=label_col, id_col=id_col, top_k=top_k).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
