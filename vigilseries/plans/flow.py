"""The whole job: from raw telemetry and logs to a ranked set of detectors."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilseries.functions.scalars import binarize_score
from vigilseries.operators.classifier import fit_block_classifier
from vigilseries.operators.decompose import seasonal_decompose
from vigilseries.operators.detectors import fit_isolation_forest, fit_lof
from vigilseries.operators.evaluate import binary_metrics, classification_report, leaderboard, macro_f1, stack_metrics
from vigilseries.operators.index import build_index
from vigilseries.operators.layout import ROW_IDX, SERIES_ID, as_list, index_rows
from vigilseries.operators.missing import impute_linear, missing_mask, missing_profile
from vigilseries.operators.neighbours import knn_classify
from vigilseries.operators.profile import (
    anomaly_day_hour_pivot, anomaly_type_counts, class_means, correlation_matrix, histogram, kde, table_summary,
)
from vigilseries.operators.rows import feature_columns
from vigilseries.operators.split import apply_scaler, chronological_split, fit_scaler
from vigilseries.operators.text import embed_text, fit_encoder, stratified_split
from vigilseries.operators.trainer import score_blocks, window_blocks
from vigilseries.operators.windows import build_features
from vigilseries.plans.stages import Once, Stages
from vigilseries.session import get_session, materialize
from vigilseries.sources.artefacts import load_model, save_model, store_embeddings
from vigilseries.sources.bundles import Bundle, load_bundle, save_bundle
from vigilseries.sources.files import METRICS, read_telemetry_csv, write_leaderboard

log = logging.getLogger(__name__)


def run_log_pipeline(logs: DataFrame, id_col: str = "id", text_col: str = "log_text", label_col: str = "category", dim: int = 256,
                     k: int = 7, test_frac: float = 0.2, seed: int = 42, out: str | None = None, encoder=None,
                     encode: Callable[[Column], Column] | None = None) -> dict:
    """Embed, store, split, classify the held-out lines and report.

    The result holds a ``bundle`` of encoder and neighbour indexes, which is
    saved below ``out``; from it log text is analysed in another session. A
    column function ``encode`` takes the place of a fitted encoder; it is not
    saved, so such a bundle needs it as ``encode`` again.
    """
    encoder = None if encode else encoder or fit_encoder(logs, text_col, dim)
    coded = embed_text(logs, text_col, dim, encoder, encode)
    split = materialize(stratified_split(coded, id_col, label_col, test_frac, seed), "logs")
    train, test = (split.where(F.col("split") == s) for s in ("train", "test"))
    payload = [label_col, text_col]
    bundle = Bundle(encoder=encoder, encode=encode, label_col=label_col, text_col=text_col, train=build_index(train, "embedding", id_col, payload=payload),
                    store=build_index(split, "embedding", id_col, payload=payload))
    if out:
        store_embeddings(split, f"{out}/vectors", [id_col], document_col=text_col)
        save_bundle(bundle, logs.sparkSession, f"{out}/log_bundle")
    found = knn_classify(test, bundle.train, "embedding", label_col, id_col, k).withColumnRenamed("label", "predicted")
    judged = materialize(test.select(F.col(id_col).alias("qid"), F.col(label_col).alias("actual")).join(found, "qid"), "judged")
    return {"predictions": judged, "report": classification_report(judged, "actual", "predicted"),
            "macro_f1": macro_f1(judged, "actual", "predicted"), "bundle": bundle}


def run_pipeline(spark: SparkSession, telemetry: DataFrame, logs: DataFrame | None = None, skip_profile: bool = False,
                 max_iter: int = 30, seed: int = 42, out: str | None = None, metrics: Sequence[str] = METRICS,
                 order_cols: Sequence[str] = ("timestamp",), window: int = 30, series_cols: Sequence[str] | None = None,
                 period: int = 288) -> dict:
    """Profile, clean, build features, split, scale, fit four detectors, analyse logs and rank.

    With ``series_cols`` every series is filled, windowed and split by itself,
    and the detectors learn from all. Imputation comes before the split, so a
    gap on a split border sees later values. A failing log stage is a warning,
    and the result holds it as ``log_error``.

    Below ``out`` each stage is marked with a digest of its input rows and
    parameters; a rerun reads the stages whose digest still holds and makes the
    others. Row, null and anomaly counts of the tables made, training history
    and test metrics are appended to ``out/runs`` at the end, the fitted parts
    saved as the next version of ``out/bundle``. ``stages`` of the result lists
    what was made.
    """
    order, series, label = list(order_cols), as_list(series_cols) or None, "is_anomaly"
    stages = Stages(spark, out, f"seed{seed}", telemetry=telemetry, logs=logs)
    result: dict = {"stages": stages.made}
    same = {"metrics": list(metrics), "order": order, "series": series}

    raw = Once(lambda: index_rows(telemetry, order, series))
    cleaned = stages.table("telemetry_clean", lambda: impute_linear(raw(), metrics, order, series), ["telemetry"], label, **same)
    if not skip_profile:
        pages = {
            "summary": lambda: table_summary(raw()), "missing": lambda: missing_profile(raw(), metrics), "means": lambda: class_means(raw(), metrics),
            "histogram": lambda: histogram(raw(), metrics), "density": lambda: kde(raw(), metrics),
            "correlation": lambda: correlation_matrix(raw(), metrics), "anomaly_types": lambda: anomaly_type_counts(raw()),
            "day_hour": lambda: anomaly_day_hour_pivot(raw()), "missing_mask": lambda: missing_mask(raw(), metrics, order),
            "decomposition": lambda: seasonal_decompose(cleaned, metrics[0], order, period, series)}
        result["profile"] = {name: stages.table(f"profile_{name}", build, ["telemetry", "telemetry_clean"], **same, period=period) for name, build in pages.items()}

    def featured():
        return chronological_split(build_features(cleaned, metrics, order, dense=True, series_cols=series), order, series_cols=series)

    split = stages.table("telemetry_features", featured, ["telemetry_clean"], label)
    fixed = {"timestamp", "is_anomaly", "anomaly_type", "split", ROW_IDX, SERIES_ID, *order, *[c for c in cleaned.columns if c not in metrics]}
    features = feature_columns(split, sorted(fixed & set(split.columns)))
    params = stages.table("scaler", lambda: fit_scaler(split.where("split = 'train'"), features), ["telemetry_features"])
    scaled = apply_scaler(split, params)
    # A row's place over all series names it.
    row = F.col(ROW_IDX) + F.col(SERIES_ID) if series else F.col(ROW_IDX)
    flat = Once(lambda: materialize(scaled.select(row.alias("row"), "split", label, F.array(*features).alias("x")), "flat"))
    # Whole windows, as those of sliding_sequences, kept as blocks of their rows.
    blocks = Once(lambda: materialize(window_blocks(scaled, features, label, order, window, series_cols=series), "blocks"))

    def part(rows: Once, name: str) -> DataFrame:
        return rows().where(F.col("split") == name)

    bundle = Bundle(scaler=params)
    scores: dict[str, DataFrame] = {}
    for kind in ("logreg", "gbt"):
        model = stages.kept(
            f"models/{kind}", lambda kind=kind: fit_block_classifier(blocks(), len(features), window, max_iter, kind=kind),
            lambda made, path, kind=kind: save_model(made, spark, path, kind), lambda path: load_model(spark, path),
            ["telemetry_features", "scaler"], max_iter=max_iter, window=window, of="whole windows")
        bundle.classifiers[kind] = result[kind] = model
        if f"models/{kind}" in stages.made:
            stages.records += [(kind, {"model": kind, "seed": seed}, {k: v for k, v in step.items() if k != "step"}, step["step"]) for step in model.history]

        def tested(model=model, kind=kind):
            found = score_blocks(part(blocks, "test"), model.model).select("label", "anomaly_score")
            judged = found.withColumn("is_anomaly_pred", binarize_score(F.col("anomaly_score"), model.threshold))
            return binary_metrics(materialize(judged, kind), "label", "is_anomaly_pred", "anomaly_score")
        scores[kind] = stages.table(f"metrics_{kind}", tested, [f"models/{kind}"])

    def saved(made, path, name):
        save_bundle(Bundle(**{name: made}), spark, path)

    bundle.forest = stages.kept(
        "models/forest", lambda: fit_isolation_forest(part(flat, "train"), "x", "row", seed=seed), lambda made, path: saved(made, path, "forest"),
        lambda path: load_bundle(spark, path).forest, ["telemetry_features", "scaler"], seed=seed)
    bundle.lof = stages.kept(
        "models/lof", lambda: fit_lof(part(flat, "train"), "x", "row"), lambda made, path: saved(made, path, "lof"),
        lambda path: load_bundle(spark, path).lof, ["telemetry_features", "scaler"])

    def judged(name):
        found = bundle.forest.transform(part(flat, "test")) if name == "forest" else bundle.lof.transform(part(flat, "test")).join(part(flat, "test").select("row", label), "row")
        return binary_metrics(materialize(found.select(label, "is_outlier", "anomaly_score"), name), label, "is_outlier", "anomaly_score")

    for name, shown in (("forest", "isolation_forest"), ("lof", "lof")):
        scores[shown] = stages.table(f"metrics_{shown}", lambda name=name: judged(name), [f"models/{name}"])
    if logs is not None:
        try:
            found = result["logs"] = run_log_pipeline(logs, seed=seed, out=out)
            bundle = replace(bundle, encoder=found["bundle"].encoder, train=found["bundle"].train, store=found["bundle"].store)
            average = found["report"].where("label = 'macro avg'").first()
            stages.records.append(("knn", {"model": "knn", "seed": seed}, {"macro_f1": average["f1"], "precision": average["precision"], "recall": average["recall"]}, None))
        except Exception as error:
            result["log_error"] = error
            log.warning("log analysis failed", exc_info=True)
    stages.records += [(name, {"model": name, "seed": seed, "set": "test"}, df.first().asDict(), None) for name, df in scores.items()]
    result["leaderboard"], result["bundle"] = leaderboard(stack_metrics(scores)), bundle
    if out:
        save_bundle(bundle, spark, f"{out}/bundle")
        write_leaderboard(result["leaderboard"], f"{out}/leaderboard")
    stages.close()
    return result


def main() -> None:
    p = argparse.ArgumentParser(description="Telemetry anomaly analytics")
    p.add_argument("telemetry", help="CSV path of the raw telemetry")
    p.add_argument("--logs", help="Parquet path of log lines (id, log_text, category, severity, error_code)")
    p.add_argument("--out", required=True)
    p.add_argument("--quick", action="store_true", help="few training iterations")
    p.add_argument("--skip-profile", action="store_true")
    p.add_argument("--max-iter", type=int, default=30)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--series", nargs="*", help="columns that name a series")
    args = p.parse_args()
    spark = get_session()
    logs = spark.read.parquet(args.logs) if args.logs else None
    result = run_pipeline(spark, read_telemetry_csv(spark, args.telemetry), logs, args.skip_profile,
                          5 if args.quick else args.max_iter, args.seed, args.out, series_cols=args.series)
    result["leaderboard"].show(truncate=False)


if __name__ == "__main__":
    main()
