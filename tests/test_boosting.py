"""Boosted trees over whole windows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigilseries.operators import boosting
from vigilseries.operators.classifier import fit_row_classifier
from vigilseries.operators.split import sliding_sequences
from vigilseries.operators.trainer import score_blocks, window_blocks
from vigilseries.plans import flow
from vigilseries.sources import artefacts
from vigilseries.sources.files import METRICS

WINDOW = 6


def rows(spark, n=1500):
    """A row is an anomaly where ``a`` was high four steps before, which neither the newest step nor the mean step shows."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"t": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n)})
    pdf["y"] = (pdf["a"].shift(4, fill_value=0) > 0.8).astype(int)
    pdf["split"] = np.where(pdf["t"] < 0.7 * n, "train", np.where(pdf["t"] < 0.85 * n, "val", "test"))
    return spark.createDataFrame(pdf)


def test_trees_see_every_step_and_stay_the_same_when_reloaded(spark, tmp_path):
    df = rows(spark)
    model = fit_row_classifier(df, ["a", "b"], "y", "t", WINDOW, max_iter=8, patience=4, kind="gbt")
    assert model.metrics["f1"] > 0.97 and model.model.numFeatures == 2 * WINDOW and model.feature_count == 2
    artefacts.save_model(model, spark, str(tmp_path / "m"))
    again = artefacts.load_model(spark, str(tmp_path / "m"))
    test = df.where("split = 'test'")
    by_block = score_blocks(window_blocks(test, ["a", "b"], "y", "t", WINDOW), model.model).orderBy("row_idx").toPandas()
    raw = sliding_sequences(test, ["a", "b"], "y", "t", WINDOW)
    by_window = again.transform(raw).orderBy("row_idx").toPandas()
    np.testing.assert_allclose(by_block["anomaly_score"], by_window["anomaly_score"], rtol=1e-12)
    assert len(by_window) == 225 - WINDOW and ((by_window["anomaly_score"] > 0.5) == by_window["label"]).mean() > 0.97
    gone = again.transform(raw.limit(2).withColumn("features", F.transform("features", lambda x: F.transform(x, lambda v: F.lit(None).cast("double")))))
    assert [r["anomaly_score"] for r in gone.collect()] == [None, None]


def test_level_sums_are_those_of_the_windows(spark):
    df = rows(spark, 700).withColumn("a", F.when(F.col("t") == 100, F.lit(None)).otherwise(F.col("a")))
    blocks = window_blocks(df.where("split != 'test'"), ["a", "b"], "y", "t", WINDOW).cache()
    edges = boosting._edges(blocks.where("split = 'train'"), 2)
    stored = boosting._stored(blocks, F.col("split") == "val", edges)
    empty = np.full((0, 15), -1), np.zeros((0, 15), np.int64), np.zeros((0, 16))
    place, cut = np.full(15, -1), np.zeros(15, np.int64)
    place[0], cut[0] = 3, 11  # step 1, feature b
    root, counts = boosting._level(stored, (WINDOW, 2), empty, (place, cut), [0], 2.0)
    left, _ = boosting._level(stored, (WINDOW, 2), empty, (place, cut), [1], 2.0)
    seq = sliding_sequences(df.where("split = 'train'"), ["a", "b"], "y", "t", WINDOW).toPandas()
    x = np.array([[list(map(float, s)) if None not in s else [np.nan] * 2 for s in w] for w in seq["features"]])
    kept = np.isfinite(x).all((1, 2))
    x, y = x[kept], seq["label"].to_numpy()[kept]
    weight = np.where(y == 1, 2.0, 1.0)
    stats = weight * (0.5 - y), weight * 0.25
    bins = np.stack([np.searchsorted(edges[f], x[..., f]) for f in range(2)], -1)
    goes_left = bins[:, 1, 1] <= 11
    for got, part in ((root[0], np.ones(len(y), bool)), (left[0], goes_left)):
        for s, stat in enumerate(stats):
            for step in range(WINDOW):
                for f in range(2):
                    want = np.bincount(bins[part, step, f], stat[part], boosting.BINS)
                    np.testing.assert_allclose(got[s, step, f], want, atol=1e-9)
    assert counts[5] == len(y)


def test_the_whole_job_trains_on_whole_windows(spark, monkeypatch):
    """Before, the models of the whole job saw the newest step and the mean step of a window only."""
    seen = {}
    monkeypatch.setattr(flow, "fit_lof", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("far enough")))
    real = flow.Stages.kept

    def kept(self, name, *args, **kwargs):
        seen[name] = real(self, name, *args, **kwargs)
        return seen[name]
    monkeypatch.setattr(flow.Stages, "kept", kept)
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"timestamp": pd.date_range("2024-01-01", periods=400, freq="5min").astype("datetime64[us]"), METRICS[0]: rng.normal(size=400)})
    pdf["is_anomaly"] = (pdf[METRICS[0]].shift(3, fill_value=0) > 1).astype(int)
    pdf["anomaly_type"] = np.where(pdf["is_anomaly"] == 1, "latency_spike", "none")
    with pytest.raises(RuntimeError, match="far enough"):
        flow.run_pipeline(spark, spark.createDataFrame(pdf), None, True, 2, metrics=METRICS[:1], window=WINDOW)
    for kind in ("logreg", "gbt"):
        model = seen[f"models/{kind}"]
        assert model.layout == "flat" and model.model.numFeatures == WINDOW * model.feature_count
