"""Bundles, resumed stages and several series in one run."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigilseries.operators import text
from vigilseries.operators.classifier import WindowClassifier
from vigilseries.operators.detectors import fit_isolation_forest, fit_lof
from vigilseries.operators.index import build_index
from vigilseries.operators.layout import index_rows
from vigilseries.operators.missing import impute_linear
from vigilseries.operators.split import chronological_split
from vigilseries.operators.windows import build_features
from vigilseries.plans import flow
from vigilseries.plans.stages import Stages, fingerprint
from vigilseries.sources import artefacts, bundles
from vigilseries.sources.files import METRICS

WORDS = {"timeout": "request timed out waiting", "normal": "heartbeat fine steady", "congestion": "queue full dropping load"}


def log_lines(spark, n=120):
    rng = np.random.default_rng(0)
    rows = [(i, f"{WORDS[c]} node{rng.integers(9)}", c, "INFO", f"E{i}") for i, c in enumerate(rng.choice(list(WORDS), n))]
    return spark.createDataFrame(rows, "id long, log_text string, category string, severity string, error_code string")


def telemetry(spark, n=400, cells=2):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"timestamp": np.repeat(pd.date_range("2024-01-01", periods=n, freq="5min"), cells), "cell": np.tile(np.arange(cells), n)})
    for j, m in enumerate(METRICS):
        pdf[m] = rng.normal(10 * j, 1, n * cells) + 1000 * pdf["cell"]
        pdf.loc[rng.random(n * cells) < 0.05, m] = np.nan
    pdf["is_anomaly"] = (rng.random(n * cells) < 0.15).astype(int)
    pdf.loc[pdf["is_anomaly"] == 1, METRICS[0]] += 30
    pdf["anomaly_type"] = np.where(pdf["is_anomaly"] == 1, "latency_spike", "none")
    return spark.createDataFrame(pdf.astype({"timestamp": "datetime64[us]"})).withColumns({m: F.nanvl(m, F.lit(None)) for m in METRICS})


def test_bundle_scores_text_and_telemetry_in_another_session(spark, tmp_path):
    path, logs = str(tmp_path / "bundle"), log_lines(spark)
    encoder = text.fit_encoder(logs, "log_text", 64)
    coded = text.embed_text(logs, "log_text", 64, encoder)
    index = build_index(coded, "embedding", "id", payload=["category", "log_text"])
    rng = np.random.default_rng(2)
    x = spark.createDataFrame(pd.DataFrame({"row": np.arange(200), "x": rng.normal(0, 1, (200, 3)).tolist()}))
    made = bundles.Bundle(forest=fit_isolation_forest(x, "x", "row", 20), lof=fit_lof(x, "x", "row", 5), encoder=encoder, train=index, store=index)
    assert bundles.load_bundle(spark, path) is None
    assert bundles.save_bundle(made, spark, path) == 1
    again = bundles.load_bundle(spark.newSession(), path)
    asked = spark.createDataFrame([(1, "request timed out again"), (2, "heartbeat fine"), (3, None)], "id long, log_text string")
    got, want = ({r.id: (r.predicted_category, r.confidence, r.similar_logs) for r in b.analyze(asked).collect()} for b in (again, made))
    assert got == want and got[1][0] == "timeout" and got[2][0] == "normal" and len(got) == 3
    for name in ("forest", "lof"):
        a, b = (getattr(m, name).transform(x).orderBy("row").toPandas()["anomaly_score"] for m in (again, made))
        np.testing.assert_allclose(a, b, rtol=1e-12)


def test_bundle_versions_switch_whole(spark, tmp_path, monkeypatch):
    path, x = str(tmp_path / "b"), spark.createDataFrame([("a", 1.0, 2.0)], "feature string, mean double, scale double")
    for _ in range(2):
        bundles.save_bundle(bundles.Bundle(scaler=x), spark, path)
    with monkeypatch.context() as m:  # a writer that dies before the switch
        m.setattr(bundles, "put_text", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            bundles.save_bundle(bundles.Bundle(scaler=x.withColumn("mean", F.lit(9.0))), spark, path)
    assert bundles.versions(spark, path) == [1, 2] and bundles.load_bundle(spark, path).scaler.first()["mean"] == 1.0
    assert bundles.load_bundle(spark, path, 7) is None
    real, seen = bundles.versions, []
    monkeypatch.setattr(bundles, "versions", lambda *a: seen.append(1) or [])  # another writer came first
    assert bundles.save_bundle(bundles.Bundle(scaler=x), spark, path) == 3 and real(spark, path) == [1, 2, 3]


def test_stages_are_made_once_and_counted(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 4 = 0 THEN NULL ELSE id END AS v", "CAST(id % 10 = 0 AS INT) AS is_anomaly")
    assert fingerprint(df) == fingerprint(df.repartition(7)) != fingerprint(df.where("id > 0")) and fingerprint(df.union(df)) != fingerprint(df)
    calls = []

    def run(source, factor):
        s = Stages(spark, str(tmp_path), "r", source=source)
        one = s.table("one", lambda: calls.append("one") or source, ["source"], "is_anomaly")
        two = s.table("two", lambda: calls.append("two") or one.selectExpr(f"v * {factor} AS w"), ["one"], factor=factor)
        s.close()
        return two.agg(F.sum("w")).first()[0], s.made
    first = run(df, 2)
    assert run(df, 2) == (first[0], []) and calls == ["one", "two"]
    assert run(df, 3)[1] == ["two"] and run(df.where("id > 5"), 3)[1] == ["one", "two"]
    with pytest.raises(ZeroDivisionError):  # a stage that fails leaves no marker, those before it stay
        s = Stages(spark, str(tmp_path), "r", source=df)
        s.table("one", lambda: df, ["source"], "is_anomaly")
        s.table("two", lambda: 1 / 0, ["one"], factor=9)
    assert run(df, 9)[1] == ["two"]
    counts = [r.metrics for r in artefacts.read_runs(spark, f"{tmp_path}/runs").where("params['stage'] = 'one'").collect()]
    assert {"rows": 100.0, "nulls": 25.0, "anomalies": 10.0} in counts and {"rows": 94.0, "nulls": 23.0, "anomalies": 9.0} in counts


def test_killed_run_resumes_and_keeps_series_apart(spark, tmp_path, monkeypatch):
    data, logs, out, metrics = telemetry(spark), log_lines(spark, 60), str(tmp_path / "out"), METRICS[:2]

    def run():
        return flow.run_pipeline(spark, data, logs, True, 2, out=out, order_cols=["timestamp"], series_cols=["cell"], window=5, metrics=metrics)
    with monkeypatch.context() as m:
        m.setattr(flow, "fit_lof", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            run()
    second = run()
    assert set(second["stages"]) == {"models/lof", "metrics_isolation_forest", "metrics_lof"} and "log_error" not in second
    monkeypatch.setattr(flow, "run_log_pipeline", lambda *a, **k: (_ for _ in ()).throw(ValueError("no logs today")))
    third = run()
    assert third["stages"] == [] and "log_error" in third
    assert third["leaderboard"].collect() == second["leaderboard"].collect() and third["leaderboard"].count() == 4
    own = impute_linear(index_rows(data.where("cell = 1"), ["timestamp"]), metrics, ["timestamp"])
    own = chronological_split(build_features(own, metrics, ["timestamp"], dense=True), ["timestamp"])
    cols = [f"{metrics[0]}_mean_5", f"{metrics[1]}_lag_5", f"{metrics[1]}_roc"]
    built = spark.read.parquet(f"{out}/telemetry_features").where("cell = 1")
    a, b = (d.orderBy("timestamp").select(*cols, "split").toPandas() for d in (built, own))
    pd.testing.assert_frame_equal(a, b)
    bundle = bundles.load_bundle(spark, f"{out}/bundle", 1)
    assert isinstance(bundle.classifiers["gbt"], WindowClassifier) and bundle.encoder is not None and bundle.lof is not None
    assert bundle.scaler.count() == bundle.classifiers["gbt"].feature_count
    runs = artefacts.read_runs(spark, f"{out}/runs")
    assert {r.run_id for r in runs.where("params['set'] = 'test'").collect()} == {"logreg", "gbt", "isolation_forest", "lof"} and runs.where("run_id = 'knn'").count() == 1
