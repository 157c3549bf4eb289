"""Named queries: each runs one operator over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilseries.functions.scalars import binarize_score, category_map, log_line_parse, round4, sigmoid, truncate_doc
from vigilseries.operators import alerts, classifier, decompose, detectors, evaluate, missing, neighbours, profile, rows, split, text, trainer, windows
from vigilseries.operators import index as index_
from vigilseries.operators.layout import ROW_IDX, SERIES_ID
from vigilseries.plans import tables as t
from vigilseries.plans.flow import run_log_pipeline, run_pipeline
from vigilseries.session import materialize, scratch_path
from vigilseries.sources import artefacts, bundles, files
from vigilseries.sources.files import METRICS
from vigilseries.streaming.jobs import stream_analyze_logs, stream_score_windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TIME = "yyyy-MM-dd HH:mm:ss"
USER = ["user_id"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as BIGINT, rounded DOUBLE, times as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            # floor on doubles: `round` would go through a decimal for every value
            c = F.floor(c.cast("double") * F.lit(10.0 ** digits) + F.lit(0.5)) / F.lit(10.0 ** digits)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, TIME)
        out.append(c.alias(f.name))
    return df.select(*out)


# --- sources and sinks ---

@query
def read_telemetry_csv(spark, sf):
    path = scratch_path(spark, "csv")
    raw = t.telemetry(spark, sf)
    spoiled = F.coalesce(F.col("packet_loss_pct").cast("string"), F.lit("n/a"))
    raw.withColumn("packet_loss_pct", spoiled).write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    back = files.read_telemetry_csv(spark, path)
    return tidy(back.withColumns({c: F.col(c).cast("bigint") for c in ("event_id", "user_id")}))


@query
def write_csv(spark, sf):
    path = scratch_path(spark, "out")
    src = t.scored(spark, sf).select("event_id", "event_type", "value")
    files.write_csv(src, path)
    return tidy(spark.read.schema(src.schema).option("header", True).csv(path))


def _board(spark, sf):
    s = t.scored(spark, sf)
    models = {}
    for name, cut in (("strict", 0.7), ("even", 0.5), ("loose", 0.2)):
        models[name] = evaluate.binary_metrics(s.withColumn("pred", binarize_score(F.col("score"), cut)), "label", "pred", "score")
    return evaluate.leaderboard(evaluate.stack_metrics(models))


@query
def leaderboard(spark, sf):
    return tidy(_board(spark, sf).withColumnRenamed("ROC-AUC", "ROC_AUC"))


@query
def write_leaderboard(spark, sf):
    path = scratch_path(spark, "board")
    board = _board(spark, sf)
    files.write_leaderboard(board, path)
    return tidy(spark.read.schema(board.schema).option("header", True).csv(path).withColumnRenamed("ROC-AUC", "ROC_AUC"))


def _split_clean(spark, sf):
    return split.chronological_split(t.clean(spark, sf), t.ORDER)


@query
def save_scaler(spark, sf):
    path = scratch_path(spark, "scaler")
    artefacts.save_scaler(split.fit_scaler(_split_clean(spark, sf).where("split = 'train'"), METRICS), path)
    return tidy(artefacts.load_scaler(spark, path))


@query
def load_scaler(spark, sf):
    path = scratch_path(spark, "scaler")
    rows_ = materialize(_split_clean(spark, sf), "split")
    artefacts.save_scaler(split.fit_scaler(rows_.where("split = 'train'"), METRICS), path)
    return tidy(split.apply_scaler(rows_.where("split = 'test'"), artefacts.load_scaler(spark, path)).select("event_id", *METRICS))


@query
def standard_scale(spark, sf):
    rows_ = materialize(_split_clean(spark, sf), "split")
    return tidy(split.apply_scaler(rows_, split.fit_scaler(rows_.where("split = 'train'"), METRICS)).select("event_id", "split", *METRICS))


def _windows(spark, sf):
    rows_ = materialize(_split_clean(spark, sf), "split")
    scaled = split.apply_scaler(rows_, split.fit_scaler(rows_.where("split = 'train'"), METRICS))
    return materialize(split.sliding_sequences(scaled, METRICS, "is_anomaly", t.ORDER), "sequences")


def _fitted(spark, sf, kind="logreg"):
    seq = _windows(spark, sf)
    model = classifier.fit_window_classifier(seq.where("split = 'train'"), seq.where("split = 'val'"), kind)
    return model, seq.where("split = 'test'")


@query
def save_model(spark, sf):
    path = scratch_path(spark, "model")
    model, test = _fitted(spark, sf)
    artefacts.save_model(model, spark, path)
    return tidy(artefacts.load_model(spark, path).transform(test).select(ROW_IDX, "label", "anomaly_score", "is_anomaly_pred"))


@query
def load_model(spark, sf):
    """Largest difference between a model's scores and those of its reloaded copy; 0 everywhere when saving is faithful."""
    path = scratch_path(spark, "model")
    model, test = _fitted(spark, sf)
    artefacts.save_model(model, spark, path)
    again = artefacts.load_model(spark, path).transform(test).select(ROW_IDX, "anomaly_score")
    return tidy(evaluate.reconcile_outputs(model.transform(test).select(ROW_IDX, "anomaly_score"), again, [ROW_IDX], ["anomaly_score"]))


@query
def model_info(spark, sf):
    path = scratch_path(spark, "model")
    model, _ = _fitted(spark, sf)
    artefacts.save_model(model, spark, path)
    info = artefacts.model_info(spark, path)
    return tidy(info.select("model_name", "model_version", "threshold", F.col("metrics")["f1"].alias("f1"), "feature_count", "window_size"))


@query
def store_embeddings(spark, sf):
    stored = artefacts.store_embeddings(t.vectors(spark, sf), scratch_path(spark, "vectors"), ["id"])
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, e: s + e * e)
    return tidy(stored.select("id", "document", "metadata.category", "metadata.severity", "metadata.error_code", F.size("embedding").alias("dim"), norm.alias("sq_norm")))


@query
def run_log(spark, sf):
    path = scratch_path(spark, "runs")
    summary = profile.table_summary(t.telemetry(spark, sf)).first()
    for step, name in enumerate(("rows", "anomalies")):
        artefacts.log_run(spark, path, {"table": "events", "metric": name}, {name: summary[name]}, step, run_id="summary")
    runs = artefacts.read_runs(spark, path)
    return tidy(runs.select("run_id", F.col("params")["metric"].alias("metric"), F.element_at("metrics", F.col("params")["metric"]).alias("value"), "step"))


# --- projections, filters, scalars ---

@query
def feature_columns(spark, sf):
    raw = t.telemetry(spark, sf)
    return tidy(raw.select("event_id", *rows.feature_columns(raw.drop("event_id", "user_id"))))


@query
def filter_class(spark, sf):
    return tidy(rows.filter_class(t.telemetry(spark, sf), 1, "latency_ms").select("event_id", "latency_ms"))


@query
def drop_warmup(spark, sf):
    return tidy(rows.drop_warmup(t.indexed(spark, sf)).select("event_id", ROW_IDX))


@query
def drop_warmup_by_user(spark, sf):
    return tidy(rows.drop_warmup(t.indexed(spark, sf, by_user=True)).select("event_id", "user_id", ROW_IDX))


@query
def head_rows(spark, sf):
    return tidy(rows.head_rows(t.telemetry(spark, sf), t.ORDER).select("event_id", "cpu_util_pct"))


@query
def category_map_(spark, sf):
    raw = t.telemetry(spark, sf)
    return tidy(raw.select("event_id", category_map(F.col("anomaly_type"), F.col("is_anomaly")).alias("category")))


@query
def category_counts(spark, sf):
    raw = t.telemetry(spark, sf)
    return tidy(profile.category_counts(raw.select(category_map(F.col("anomaly_type"), F.col("is_anomaly")).alias("category"))))


@query
def binarize_score_(spark, sf):
    return tidy(t.scored(spark, sf).select("event_id", binarize_score(F.col("score"), 0.5).alias("flag")))


@query
def sigmoid_(spark, sf):
    return tidy(t.scored(spark, sf).select("event_id", sigmoid((F.col("value") - 50.0) / 25.0).alias("p")))


@query
def round4_(spark, sf):
    return tidy(t.scored(spark, sf).select("event_id", round4(F.col("score")).alias("score")))


@query
def truncate_doc_(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return tidy(docs.select("doc_id", truncate_doc(F.col("text")).alias("document")))


@query
def log_line_format(spark, sf):
    return tidy(t.log_lines(spark, sf).select("event_id", "log_text"))


@query
def log_line_parse_(spark, sf):
    """Every line, plus the bare message of each event as a malformed line."""
    lines = t.log_lines(spark, sf)
    all_lines = lines.select("event_id", F.lit(0).alias("broken"), "log_text").unionByName(
        lines.select("event_id", F.lit(1).alias("broken"), F.col("message").alias("log_text")))
    return tidy(all_lines.select("event_id", "broken", *[c.alias(n) for n, c in log_line_parse(F.col("log_text")).items()]))


@query
def time_parts(spark, sf):
    return tidy(windows.time_parts(t.telemetry(spark, sf)).select("event_id", "hour", "weekday", "day_name"))


@query
def time_features(spark, sf):
    return tidy(windows.time_features(t.telemetry(spark, sf)).select("event_id", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend"))


# --- missing data ---

@query
def missing_profile(spark, sf):
    return tidy(missing.missing_profile(t.telemetry(spark, sf), METRICS))


@query
def missing_mask(spark, sf):
    return tidy(missing.missing_mask(t.telemetry(spark, sf), METRICS, t.ORDER).drop("timestamp"))


@query
def impute_linear(spark, sf):
    return tidy(missing.impute_linear(t.telemetry(spark, sf), METRICS, t.ORDER).select("event_id", *METRICS))


@query
def impute_linear_by_user(spark, sf):
    return tidy(missing.impute_linear(t.telemetry(spark, sf), METRICS, t.ORDER, USER).select("event_id", *METRICS))


@query
def impute_forward_linear(spark, sf):
    return tidy(missing.impute_forward_linear(t.telemetry(spark, sf), METRICS, t.ORDER).select("event_id", *METRICS))


@query
def ffill_zero(spark, sf):
    return tidy(missing.ffill_zero(t.telemetry(spark, sf), METRICS, t.ORDER).select("event_id", *METRICS))


@query
def fill_stat_zero(spark, sf):
    """Spread of each user's single-type days is undefined and counts as 0."""
    daily = t.events(spark, sf).groupBy("user_id", "event_type", F.to_date("ts").cast("string").alias("day"))
    return tidy(daily.agg(missing.fill_stat_zero(F.stddev_samp("value")).alias("std")))


# --- profiling ---

@query
def table_summary(spark, sf):
    return tidy(profile.table_summary(t.telemetry(spark, sf)))


@query
def class_means(spark, sf):
    return tidy(profile.class_means(t.telemetry(spark, sf), METRICS))


@query
def histogram(spark, sf):
    return tidy(profile.histogram(t.telemetry(spark, sf), METRICS))


@query
def kde(spark, sf):
    return tidy(profile.kde(t.telemetry(spark, sf), METRICS))


@query
def correlation_matrix(spark, sf):
    return tidy(profile.correlation_matrix(t.clean(spark, sf), METRICS))


@query
def anomaly_type_counts(spark, sf):
    return tidy(profile.anomaly_type_counts(t.telemetry(spark, sf)))


@query
def anomaly_day_hour_pivot(spark, sf):
    return tidy(profile.anomaly_day_hour_pivot(t.telemetry(spark, sf)))


@query
def split_summary(spark, sf):
    return tidy(split.split_summary(split.chronological_split(t.telemetry(spark, sf), t.ORDER)))


@query
def class_weight(spark, sf):
    return tidy(split.class_weight(t.telemetry(spark, sf)))


# --- windows ---

@query
def rolling_stats(spark, sf):
    return tidy(windows.rolling_stats(t.clean(spark, sf), METRICS, t.ORDER).drop("timestamp", "user_id", ROW_IDX, *METRICS, "is_anomaly", "anomaly_type"))


@query
def rolling_stats_by_user(spark, sf):
    rolled = windows.rolling_stats(t.events(spark, sf).select("event_id", "user_id", "ts", "value"), ["value"], ["ts", "event_id"], series_cols=USER)
    return tidy(rolled.drop("ts", ROW_IDX, SERIES_ID))


@query
def rolling_mean_std(spark, sf):
    out = windows.rolling_mean_std(t.telemetry(spark, sf), METRICS, t.ORDER)
    return tidy(out.select("event_id", *[c for c in out.columns if "_roll_" in c]))


@query
def rolling_mean_std_valid(spark, sf):
    out = windows.rolling_mean_std_valid(t.telemetry(spark, sf), METRICS, t.ORDER)
    return tidy(out.select("event_id", *[c for c in out.columns if "_roll_" in c]))


@query
def lag_features(spark, sf):
    out = windows.lag_features(t.clean(spark, sf), METRICS, t.ORDER)
    return tidy(out.select("event_id", *[c for c in out.columns if "_lag_" in c]))


@query
def lag_features_by_user(spark, sf):
    out = windows.lag_features(t.events(spark, sf), ["value"], ["ts", "event_id"], series_cols=USER)
    return tidy(out.select("event_id", *[c for c in out.columns if "_lag_" in c]))


@query
def rate_of_change(spark, sf):
    out = windows.rate_of_change(t.clean(spark, sf), METRICS, t.ORDER)
    return tidy(out.select("event_id", *[c for c in out.columns if c.endswith("_roc")]))


@query
def build_features(spark, sf):
    built = windows.build_features(t.clean(spark, sf), METRICS, t.ORDER, dense=True)
    return tidy(built.drop("user_id", "timestamp"), 5)


@query
def build_features_gaps(spark, sf):
    """All features of the telemetry as it came: what is undefined takes the last known value."""
    built = windows.build_features(t.indexed(spark, sf), METRICS, t.ORDER)
    return tidy(built.drop("user_id", "timestamp"), 5)


@query
def chronological_split(spark, sf):
    return tidy(split.chronological_split(t.telemetry(spark, sf), t.ORDER).select("event_id", "split"))


@query
def chronological_split_by_user(spark, sf):
    return tidy(split.chronological_split(t.telemetry(spark, sf), t.ORDER, series_cols=USER).select("event_id", "user_id", "split"))


@query
def sliding_sequences(spark, sf):
    """Each window by its size, ends and total."""
    seq = split.sliding_sequences(_split_clean(spark, sf), METRICS, "is_anomaly", t.ORDER)
    return tidy(seq.select(
        ROW_IDX, "split", "label", F.size("features").alias("steps"), F.col("features")[0][0].alias("first_x"),
        F.element_at("features", -1)[1].alias("last_y"),
        F.aggregate(F.flatten("features"), F.lit(0.0), lambda s, x: s + x).alias("total")))


@query
def last_window(spark, sf):
    """The newest 30 steps of each user; users with fewer are rejected."""
    out = split.newest_window(t.events(spark, sf), ["value"], ["ts", "event_id"], USER)
    return tidy(out.select("user_id", "error", F.aggregate(F.flatten("features"), F.lit(0.0), lambda s, x: s + x).alias("total")))


@query
def seasonal_decompose(spark, sf):
    src = t.events(spark, sf).select("event_id", "ts", F.log1p("value").alias("value"))
    out = decompose.seasonal_decompose(src, "value", ["ts", "event_id"])
    return tidy(out.select("event_id", "observed", "trend", "seasonal", "resid"))


@query
def seasonal_decompose_by_user(spark, sf):
    src = t.events(spark, sf).select("event_id", "user_id", "ts", "value")
    out = decompose.seasonal_decompose(src, "value", ["ts", "event_id"], 7, USER)
    return tidy(out.select("event_id", "user_id", "trend", "seasonal", "resid"))


# --- evaluation ---

@query
def binary_metrics(spark, sf):
    return tidy(evaluate.binary_metrics(t.scored(spark, sf), "label", "pred", "score"))


@query
def confusion_matrix(spark, sf):
    return tidy(evaluate.confusion_matrix(t.scored(spark, sf), "label", "pred"))


def _guessed(spark, sf):
    guess = F.when(F.col("score") > 0.6, F.lit("view")).when(F.col("score") > 0.3, F.lit("click")).otherwise(F.col("event_type"))
    return t.scored(spark, sf).withColumn("guess", guess)


@query
def classification_report(spark, sf):
    return tidy(evaluate.classification_report(_guessed(spark, sf), "event_type", "guess"))


@query
def macro_f1(spark, sf):
    return tidy(evaluate.macro_f1(_guessed(spark, sf), "event_type", "guess"))


@query
def optimise_threshold(spark, sf):
    return tidy(evaluate.optimise_threshold(t.scored(spark, sf), "score", "label"))


@query
def reconcile_outputs(spark, sf):
    """The two rolling definitions against each other: they part where values are missing."""
    base = t.indexed(spark, sf)
    a = windows.rolling_mean_std(base, METRICS, t.ORDER)
    b = windows.rolling_mean_std_valid(base, METRICS, t.ORDER)
    return tidy(evaluate.reconcile_outputs(a, b, ["event_id"], [f"{m}_roll_mean_15" for m in METRICS]))


@query
def overlay_episodes(spark, sf):
    out = alerts.overlay_episodes(t.indexed(spark, sf), t.episodes(spark, sf), t.ORDER, METRICS)
    return tidy(out.select("event_id", *METRICS, "is_anomaly", "anomaly_type"))


@query
def unified_alert(spark, sf):
    step = F.unix_timestamp(F.date_trunc("hour", "ts")) + F.floor(F.minute("ts") / 5) * 300
    ev = t.events(spark, sf).withColumn("step", step)
    scores = ev.groupBy("step").agg(F.avg(F.col("value") / (F.col("value") + 50.0)).alias("p_seq"))
    logs = ev.where(F.col("value") > t.HIGH).select("step", (F.col("value") / (F.col("value") + 150.0)).alias("p_anomaly"))
    return tidy(alerts.unified_alert(scores, logs, "step"))


# --- detectors ---

def _flat(spark, sf):
    rows_ = materialize(_split_clean(spark, sf), "split")
    scaled = split.apply_scaler(rows_, split.fit_scaler(rows_.where("split = 'train'"), METRICS))
    return materialize(scaled.select("event_id", "split", "is_anomaly", F.array(*METRICS).alias("x")), "flat")


@query
def isolation_forest(spark, sf):
    flat = _flat(spark, sf)
    model = detectors.fit_isolation_forest(flat.where("split = 'train'"), "x", "event_id")
    return tidy(model.transform(flat.where("split = 'test'")).select("event_id", "is_anomaly", "anomaly_score", "is_outlier"))


@query
def local_outlier_factor(spark, sf):
    parts = materialize(text.stratified_split(t.vectors(spark, sf).select("id", "embedding", "category"), "id", "category"), "lof")
    return tidy(detectors.local_outlier_factor(parts.where("split = 'train'"), parts.where("split = 'test'"), "embedding", "id"))


@query
def local_outlier_factor_telemetry(spark, sf):
    flat = _flat(spark, sf)
    return tidy(detectors.local_outlier_factor(flat.where("split = 'train'"), flat.where("split = 'test'"), "x", "event_id"))


@query
def window_classifier(spark, sf):
    model, test = _fitted(spark, sf, "gbt")
    return tidy(model.transform(test).select(ROW_IDX, "label", "anomaly_score", "is_anomaly_pred", "threshold"))


@query
def score_windows(spark, sf):
    """Requests are unscaled windows; the fitted scaler goes in with the model."""
    rows_ = materialize(_split_clean(spark, sf), "split")
    params = split.fit_scaler(rows_.where("split = 'train'"), METRICS)
    model, _ = _fitted(spark, sf)
    requests = split.sliding_sequences(rows_, METRICS, "is_anomaly", t.ORDER).where("split = 'test'")
    return tidy(classifier.score_windows(requests, model, params).select(ROW_IDX, "anomaly_score", "is_anomaly_pred", "threshold", "error"))


@query
def score_windows_scaled(spark, sf):
    """Whether raw windows with the scaler and windows scaled before get the same score, per test window."""
    rows_ = materialize(_split_clean(spark, sf), "split")
    params = materialize(split.fit_scaler(rows_.where("split = 'train'"), METRICS), "params")
    model, scaled = _fitted(spark, sf)
    raw = split.sliding_sequences(rows_, METRICS, "is_anomaly", t.ORDER).where("split = 'test'")
    one = classifier.score_windows(raw, model, params).select(ROW_IDX, "error", F.col("anomaly_score").alias("a"), F.col("is_anomaly_pred").alias("flag"))
    two = model.transform(scaled).select(ROW_IDX, F.col("anomaly_score").alias("b"))
    return tidy(one.join(two, ROW_IDX, "full").select(ROW_IDX, "error", (F.abs(F.col("a") - F.col("b")) < 1e-9).alias("same_score"),
                                                     (F.col("flag") == (F.col("b") >= model.threshold).cast("int")).alias("flag_fits")))


@query
def model_info_recomputed(spark, sf):
    """The saved facts of a model, and whether its F1 and threshold come out again from the validation windows."""
    path = scratch_path(spark, "model")
    seq = _windows(spark, sf)
    model = classifier.fit_window_classifier(seq.where("split = 'train'"), seq.where("split = 'val'"), "logreg")
    artefacts.save_model(model, spark, path)
    again = materialize(artefacts.load_model(spark, path).transform(seq.where("split = 'val'")).select("label", "is_anomaly_pred", "anomaly_score"), "again")
    scores = evaluate.binary_metrics(again, "label", "is_anomaly_pred", "anomaly_score").first()
    info = artefacts.model_info(spark, path)
    return tidy(info.select("model_name", "model_version", "feature_count", "window_size", F.col("threshold").between(0.01, 0.99).alias("threshold_on_grid"),
                            (F.abs(F.col("metrics")["f1"] - F.lit(scores["f1"])) < 1e-9).alias("same_f1")))


@query
def window_classifier_rows(spark, sf):
    """Trained from the rows over all features and whole windows; every test window is scored, alike after a reload."""
    path = scratch_path(spark, "model")
    built = windows.build_features(t.clean(spark, sf), METRICS, t.ORDER, dense=True)
    names = rows.feature_columns(built.drop("event_id", "user_id", ROW_IDX))
    rows_ = materialize(split.chronological_split(built, t.ORDER), "split")
    scaled = split.apply_scaler(rows_, split.fit_scaler(rows_.where("split = 'train'"), names))
    model = classifier.fit_row_classifier(scaled, names, "is_anomaly", t.ORDER, max_iter=12, patience=4)
    artefacts.save_model(model, spark, path)
    again = artefacts.load_model(spark, path).model
    test = materialize(trainer.window_blocks(scaled, names, "is_anomaly", t.ORDER).where("split = 'test'"), "test")
    one, two = (trainer.score_blocks(test, m).select("split", ROW_IDX, F.col("label").cast("int").alias("label"), "anomaly_score") for m in (model.model, again))
    both = one.join(two.select(ROW_IDX, F.col("anomaly_score").alias("b")), ROW_IDX)
    return tidy(both.select(ROW_IDX, "split", "label", F.col("anomaly_score").between(0, 1).alias("scored"), (F.col("anomaly_score") == F.col("b")).alias("same_after_reload")))


@query
def isolation_forest_planted(spark, sf):
    """Every test row and a copy of it far outside the telemetry; the copies must be flagged, whichever rows are."""
    flat = _flat(spark, sf)
    model = detectors.fit_isolation_forest(flat.where("split = 'train'"), "x", "event_id")
    test = flat.where("split = 'test'").select("event_id", "x", F.lit(0).alias("planted"))
    far = test.select("event_id", F.transform("x", lambda v: v + 1000.0).alias("x"), F.lit(1).alias("planted"))
    found = model.transform(test.unionByName(far))
    return tidy(found.select("event_id", "planted", F.when(F.col("planted") == 1, F.col("is_outlier")).alias("flagged"),
                             (F.col("anomaly_score") - F.lit(float(model.offset))).between(0, 1).alias("in_range")))


# --- log analytics ---

def _vowels(col):
    return F.array(*[(F.length(col) - F.length(F.replace(col, F.lit(c), F.lit("")))).cast("double") for c in "aeiou"])


def _vowel_model():
    """Loads a model that counts each vowel of each text."""
    return lambda texts: np.array([[x.count(c) for c in "aeiou"] for x in texts], float)


def _coded(df):
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, e: s + e * e)
    return tidy(df.select("id", F.size("embedding").alias("dim"), F.element_at("embedding", 1).alias("first_dim"), norm.alias("sq_norm")))


@query
def embed_text_letters(spark, sf):
    """Texts coded by a given column function: how often each vowel occurs."""
    return _coded(text.embed_text(t.document_text(spark, sf), "log_text", encoder=_vowels))


@query
def embed_text_batched(spark, sf):
    """The same by a Python model, loaded once per worker and given batches."""
    return _coded(text.embed_text(t.document_text(spark, sf), "log_text", encoder=text.batched_encoder("vowels", _vowel_model)))


@query
def embed_text(spark, sf):
    coded = text.embed_text(t.document_text(spark, sf), "log_text")
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, e: s + e * e)
    return tidy(coded.select("id", F.size("embedding").alias("dim"), norm.alias("sq_norm")))


@query
def label_encode(spark, sf):
    coded, model = text.label_encode(t.vectors(spark, sf), "category")
    return tidy(text.label_decode(coded, model).select("id", "category", "label_id", "label_name"))


@query
def stratified_split(spark, sf):
    return tidy(text.stratified_split(t.vectors(spark, sf).select("id", "category"), "id", "category"))


def _stored(spark, sf):
    parts = materialize(text.stratified_split(t.vectors(spark, sf), "id", "category"), "vectors")
    return parts.where("split = 'test'"), parts.where("split = 'train'"), parts


@query
def knn_classify(spark, sf):
    test, train, _ = _stored(spark, sf)
    return tidy(neighbours.knn_classify(test, train, "embedding", "category", "id"))


@query
def knn_anomaly_prob(spark, sf):
    test, train, _ = _stored(spark, sf)
    return tidy(neighbours.knn_anomaly_prob(test, train, "embedding", "category", "id").select("qid", "p_anomaly"))


@query
def similar_logs(spark, sf):
    store = t.vectors(spark, sf)
    return tidy(neighbours.similar_logs(store, store, payload=["log_text", "category"]))


@query
def similar_logs_stored(spark, sf):
    """Searched in an index that was written and opened again."""
    store, path = t.vectors(spark, sf), scratch_path(spark, "index")
    index_.build_index(store, "embedding", "id", path, payload=["log_text", "category"])
    return tidy(neighbours.similar_logs(store, index_.load_index(spark, path), payload=["log_text", "category"]))


@query
def similar_logs_recall(spark, sf):
    """How much of the exact answer approximate search finds, over all vectors."""
    store = t.vectors(spark, sf)
    index = index_.build_index(store, "embedding", "id")
    exact = materialize(neighbours.similar_logs(store, index), "exact")
    found = neighbours.similar_logs(store, index, approx=True).select("qid", "cid", F.lit(1).alias("hit"))
    both = exact.join(found, ["qid", "cid"], "left").agg(F.countDistinct("qid").alias("queries"), (F.avg(F.coalesce("hit", F.lit(0))) >= 0.9).alias("enough"))
    return tidy(both)


@query
def analyze_log_text(spark, sf):
    """Labelled documents as log lines in plain text, each with its own number of similar logs, against stored indexes."""
    lines = text.embed_text(t.labelled_text(spark, sf), "log_text", encoder=_vowels)
    parts = materialize(text.stratified_split(lines, "id", "category"), "lines")
    train, store = (index_.build_index(df, "embedding", "id", payload=["log_text", "category"]) for df in (parts.where("split = 'train'"), parts))
    asked = parts.where("split = 'test'").select("id", "log_text", F.expr("CAST(id % 10 + 1 AS INT)").alias("top_k"))
    out = neighbours.analyze_logs(asked, train, store, lambda df: text.embed_text(df, "log_text", encoder=_vowels), document_col="log_text",
                                  metadata_col=None, top_k="top_k")
    total = F.aggregate("similar_logs", F.lit(0.0), lambda s, e: s + e["similarity"])
    return tidy(out.select("id", "predicted_category", "confidence", F.size("similar_logs").alias("n_similar"), total.alias("similarity")), 3)


@query
def analyze_logs(spark, sf):
    test, train, store = _stored(spark, sf)
    out = neighbours.analyze_embedded(test, train, store, document_col="log_text", metadata_col=None)
    return tidy(out.select("id", "predicted_category", "confidence", F.concat_ws("; ", F.transform("similar_logs", lambda e: e["document"])).alias("near_logs")))


@query
def log_pipeline(spark, sf):
    return tidy(run_log_pipeline(t.labelled_text(spark, sf))["report"])


@query
def log_pipeline_letters(spark, sf):
    """The same job with a given column function as encoder."""
    return tidy(run_log_pipeline(t.labelled_text(spark, sf), encode=_vowels)["report"])


@query
def load_bundle(spark, sf):
    """Differences between the answers of a log bundle and of its reloaded copy, for all documents as text; 0 when saving is faithful."""
    path, asked = scratch_path(spark, "bundle"), t.document_text(spark, sf)
    made = run_log_pipeline(t.labelled_text(spark, sf))["bundle"]
    bundles.save_bundle(made, spark, path)
    answers = [materialize(b.analyze(asked, top_k=1).select("id", "confidence", "p_anomaly", F.col("similar_logs")[0]["similarity"].alias("similarity")), "answers")
               for b in (made, bundles.load_bundle(spark, path))]
    return tidy(evaluate.reconcile_outputs(*answers, ["id"], ["confidence", "p_anomaly", "similarity"]))


# --- streams ---

@query
def stream_score_windows_(spark, sf):
    """Events arrive as a stream; each is scored against the last 30 of its user."""
    stream = t.streamed(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    out = scratch_path(spark, "scored")

    def scorer(recent):
        gap = (F.col("value") - F.col("value_roll_mean_30")) / (F.col("value_roll_std_30") + 1.0)
        return recent.withColumn("anomaly_score", sigmoid(gap))

    stream_score_windows(stream, out, scratch_path(spark, "offsets"), ["value"], ["ts", "event_id"], USER, scorer).awaitTermination()
    return tidy(spark.read.parquet(out).select("event_id", "value_roll_mean_30", "value_roll_std_30", "anomaly_score"))


@query
def stream_analyze_logs_(spark, sf):
    """Labelled documents arrive as a stream and meet the vectors of the train split."""
    logs = t.labelled_text(spark, sf)
    encoder = text.fit_encoder(logs, "log_text")
    parts = materialize(text.stratified_split(text.embed_text(logs, "log_text", model=encoder), "id", "category"), "logs")
    stream = t.streamed(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("log_text"))
    out = scratch_path(spark, "analyzed")
    store = parts.withColumnRenamed("log_text", "document").withColumn("metadata", F.struct("category", "severity", "error_code"))
    stream_analyze_logs(stream, out, scratch_path(spark, "offsets"), store.where("split = 'train'"), store, encoder).awaitTermination()
    return tidy(spark.read.parquet(out).select("id", "predicted_category", "confidence", F.size("similar_logs").alias("n_similar")))


@query
def run_pipeline_(spark, sf):
    result = run_pipeline(spark, t.telemetry(spark, sf), t.labelled_text(spark, sf), order_cols=t.ORDER)
    return tidy(result["leaderboard"].withColumnRenamed("ROC-AUC", "ROC_AUC"))


def _named(name: str) -> str:
    return name.rstrip("_")


QUERIES = {_named(k): v for k, v in QUERIES.items()}
