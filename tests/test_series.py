"""Order, filling and windows against pandas, with chunks far smaller than the series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigilseries.operators import decompose, layout, missing, split, windows

M = ["a", "b"]


def frame(n=700, series=("x", None, "y"), seed=0, gap=(100, 330)):
    """Series of uneven length; one has a null key; values are missing at random and over a long gap."""
    rng = np.random.default_rng(seed)
    parts = []
    for k, s in enumerate(series):
        size = n if k == 0 else n // (5 * k)
        pdf = pd.DataFrame({"s": s, "t": np.arange(size), "a": rng.normal(50, 9, size).round(2), "b": rng.normal(0, 1, size)})
        pdf.loc[rng.random(size) < 0.2, "a"] = np.nan
        pdf.loc[gap[0]:gap[1], "a"] = np.nan
        parts.append(pdf)
    return pd.concat(parts, ignore_index=True)


def load(spark, pdf):
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(5)
    return df.withColumns({m: F.when(~F.isnan(m), F.col(m)) for m in M})


def back(df, pdf):
    out = df.toPandas()
    out["s"] = out["s"].fillna("-")
    assert len(out) == len(pdf)
    return out.sort_values(["s", "t"], ignore_index=True)


def expected(pdf, fn):
    p = pdf.assign(s=pdf["s"].fillna("-")).sort_values(["s", "t"], ignore_index=True)
    return pd.concat([fn(g.reset_index(drop=True)) for _, g in p.groupby("s")], ignore_index=True)


def test_index_is_dense_per_series_even_for_copies(spark):
    pdf = frame()
    copies = pd.concat([pdf, pd.concat([pdf.iloc[[3]]] * 400)], ignore_index=True)
    got = layout.index_rows(load(spark, copies), ["t"], ["s"]).toPandas()
    for _, g in got.groupby(got["s"].fillna("-")):
        assert sorted(g["row_idx"]) == list(range(len(g)))
        assert g.sort_values("row_idx")["t"].is_monotonic_increasing
    assert got.groupby(got["s"].fillna("-"))["series_id"].nunique().eq(1).all()


@pytest.mark.parametrize("chunk", [32, 5000])
def test_impute_matches_pandas(spark, chunk):
    pdf = frame()
    got = back(missing.impute_linear(load(spark, pdf), M, ["t"], ["s"], chunk), pdf)
    want = expected(pdf, lambda g: g.assign(a=g["a"].interpolate(limit_direction="both").bfill().ffill()))
    np.testing.assert_allclose(got["a"], want["a"], atol=1e-9)


def test_impute_without_any_value_and_single_row(spark):
    df = spark.createDataFrame([("p", 0, None, 1.0), ("p", 1, None, None), ("q", 0, 5.0, None)], "s string, t int, a double, b double")
    got = {(r.s, r.t): (r.a, r.b) for r in missing.impute_linear(df, M, ["t"], ["s"]).collect()}
    assert got == {("p", 0): (None, 1.0), ("p", 1): (None, 1.0), ("q", 0): (5.0, None)}
    filled = {(r.s, r.t): r.a for r in missing.ffill_zero(df, ["a"], ["t"], ["s"]).collect()}
    assert filled == {("p", 0): 0.0, ("p", 1): 0.0, ("q", 0): 5.0}


@pytest.mark.parametrize("chunk", [32, 5000])
def test_rolling_matches_pandas(spark, chunk):
    pdf = frame()
    got = back(windows.rolling_stats(load(spark, pdf), M, ["t"], (5, 7, 15, 30), ["s"], chunk), pdf)

    def want(g):
        out = {}
        for m in M:
            for w in (5, 7, 15, 30):
                r = g[m].rolling(w, min_periods=1)
                out |= {f"{m}_mean_{w}": r.mean(), f"{m}_std_{w}": r.std().fillna(0.0), f"{m}_min_{w}": r.min(), f"{m}_max_{w}": r.max()}
        return pd.DataFrame(out)
    want = expected(pdf, want)
    for c in want:
        np.testing.assert_allclose(got[c], want[c], atol=1e-9, err_msg=c)


def test_rolling_std_of_large_near_constant_values(spark):
    pdf = pd.DataFrame({"s": "x", "t": range(90), "a": [1e9 + 0.001 * (i % 3) for i in range(90)], "b": 7.7})
    got = back(windows.rolling_stats(load(spark, pdf), M, ["t"], (30,)), pdf)
    want = [np.std(pdf["a"][max(0, i - 29):i + 1], ddof=1) if i else 0.0 for i in range(90)]
    np.testing.assert_allclose(got["a_std_30"], want, atol=1e-7)
    np.testing.assert_allclose(got["b_std_30"], 0, atol=1e-12)


def test_lag_diff_and_features(spark):
    pdf = frame()
    df = layout.index_rows(load(spark, pdf), ["t"], ["s"])
    got = back(windows.lag_features(df, M, ["t"], series_cols=["s"], chunk=32), pdf)
    roc = back(windows.rate_of_change(df, M, ["t"], ["s"], 32), pdf)
    want = expected(pdf, lambda g: pd.DataFrame({**{f"a_lag_{k}": g["a"].shift(k) for k in (1, 5, 15, 30)}, "a_roc": g["a"].diff().fillna(0.0)}))
    for k in (1, 5, 15, 30):
        np.testing.assert_allclose(got[f"a_lag_{k}"], want[f"a_lag_{k}"])
    np.testing.assert_allclose(roc["a_roc"], want["a_roc"], atol=1e-12)


@pytest.mark.parametrize("dense", [True, False])
def test_build_features_matches_pandas(spark, dense):
    pdf = frame()
    if dense:
        pdf["a"] = expected(pdf, lambda g: g)["a"].interpolate().bfill()
    pdf["timestamp"] = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=5 * int(t)) for t in pdf["t"]]
    got = windows.build_features(load(spark, pdf), M, ["t"], series_cols=["s"], chunk=64, dense=dense).toPandas()
    got["s"] = got["s"].fillna("-")
    got = got.sort_values(["s", "t"], ignore_index=True)

    def want(g):
        out = g.copy()
        for m in M:
            for w in (5, 15, 30):
                r = g[m].rolling(w, min_periods=1)
                out[f"{m}_mean_{w}"], out[f"{m}_std_{w}"] = r.mean(), r.std().fillna(0.0)
                out[f"{m}_min_{w}"], out[f"{m}_max_{w}"] = r.min(), r.max()
            for k in (1, 5, 15, 30):
                out[f"{m}_lag_{k}"] = g[m].shift(k)
            out[f"{m}_roc"] = g[m].diff().fillna(0.0)
        out = out.iloc[30:].reset_index(drop=True)
        cols = [c for c in out if c not in ("s", "t", "timestamp")]
        out[cols] = out[cols].ffill().fillna(0.0)
        return out
    want = expected(pdf, want)
    for c in [c for c in want if c not in ("s", "timestamp")]:
        np.testing.assert_allclose(got[c], want[c], atol=1e-9, err_msg=c)


def test_rolling_over_present_values(spark):
    pdf = frame()
    got = back(windows.rolling_mean_std_valid(load(spark, pdf), M, ["t"], 4, ["s"], 32), pdf)

    def want(g):
        last, rows = [], []
        for v in g["a"]:
            if v == v:
                last = [*last, v][-4:]
            rows.append((np.mean(last) if last else 0.0, np.std(last, ddof=1) if len(last) > 1 else 0.0))
        return pd.DataFrame(rows, columns=["mean", "std"])
    want = expected(pdf, want)
    np.testing.assert_allclose(got["a_roll_mean_4"], want["mean"], atol=1e-9)
    np.testing.assert_allclose(got["a_roll_std_4"], want["std"], atol=1e-9)


def test_missing_metric_is_skipped(spark):
    out = windows.rolling_mean_std(load(spark, frame()), ["a", "nope"], ["t"], 3, ["s"])
    assert "a_roll_mean_3" in out.columns and not any("nope" in c for c in out.columns)


@pytest.mark.parametrize("period", [6, 7])
def test_decompose_recovers_line_plus_season(spark, period):
    n, season = 16 * period, np.sin(np.arange(period))
    season -= season.mean()
    x = np.arange(n)
    pdf = pd.DataFrame({"s": "x", "t": x, "a": 3.0 + 0.5 * x + season[x % period], "b": 0.0})
    short = pd.DataFrame({"s": "short", "t": range(period), "a": 1.0, "b": 0.0})
    out = decompose.seasonal_decompose(load(spark, pd.concat([pdf, short])), "a", ["t"], period, ["s"], chunk=40).toPandas().sort_values("t")
    assert len(out) == n  # the short series is left out
    np.testing.assert_allclose(out["trend"], 3.0 + 0.5 * x, atol=1e-8)
    np.testing.assert_allclose(out["seasonal"], season[x % period], atol=1e-8)
    np.testing.assert_allclose(out["resid"], 0, atol=1e-8)


def test_split_and_sequences(spark):
    pdf = frame()
    df = split.chronological_split(load(spark, pdf).fillna(0.0, M).withColumn("y", (F.col("t") % 5 == 0).cast("int")), ["t"], series_cols=["s"])
    sizes = {(r["s"], r["split"]): r["n"] for r in df.groupBy("s", "split").agg(F.count("*").alias("n")).collect()}
    for s, n in (("x", 700), (None, 140), ("y", 70)):
        assert sizes[s, "train"] == int(n * 0.7) and sizes[s, "val"] == int(n * 0.15)
    for include_last in (False, True):
        seq = split.sliding_sequences(df, M, "y", ["t"], 8, include_last, series_cols=["s"], chunk=32).toPandas()
        assert len(seq) == sum(max(0, n - 8 + include_last) for n in sizes.values())
        one = seq[(seq["split"] == "train") & (seq["row_idx"] == 100)].iloc[0]
        assert len(one["features"]) == 8 and one["label"] == 1
    x = df.where("s = 'x'").toPandas().set_index("t").sort_index()
    np.testing.assert_allclose([list(v) for v in one["features"]], x.loc[93:100, M].to_numpy())


def test_window_summaries_match_sequences(spark):
    df = split.chronological_split(load(spark, frame()).fillna(0.0, M).withColumn("y", (F.col("t") % 5 == 0).cast("int")), ["t"], series_cols=["s"])
    args = (df, M, "y", ["t"], 8, False)
    seq, short = (f(*args, series_cols=["s"], chunk=32).toPandas().sort_values(["series_id", "row_idx"], ignore_index=True)
                  for f in (split.sliding_sequences, split.window_summaries))
    assert seq[["series_id", "row_idx", "split", "label"]].equals(short[["series_id", "row_idx", "split", "label"]])
    for raw, brief in zip(seq["features"], short["features"]):
        x = np.array([list(v) for v in raw])
        np.testing.assert_allclose(brief, [*x[-1], *x.mean(0)], atol=1e-9)


def test_scaler_constant_column_and_persistence(spark, tmp_path):
    from vigilseries.sources import artefacts
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    params = split.fit_scaler(df, M)
    artefacts.save_scaler(params, f"{tmp_path}/scaler")
    rows = split.apply_scaler(df, artefacts.load_scaler(spark, f"{tmp_path}/scaler")).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]
    assert artefacts.load_scaler(spark, f"{tmp_path}/none") is None and artefacts.load_model(spark, f"{tmp_path}/none") is None


def test_index_reuse_is_guarded(spark):
    pdf = pd.DataFrame({"g": [i % 3 for i in range(60)], "t": range(60), "x": [float(i * i % 17) for i in range(60)]})
    df = spark.createDataFrame(pdf)
    by_g, one = layout.index_rows(df, ["t"], ["g"]), layout.index_rows(df, ["t"])
    want = windows.rolling_mean_std(df, ["x"], ["t"], window=5).orderBy("t").toPandas()["x_roll_mean_5"]
    # made for other series: numbered again
    got = windows.rolling_mean_std(by_g, ["x"], ["t"], window=5).orderBy("t").toPandas()["x_roll_mean_5"]
    np.testing.assert_allclose(got, want)
    # filtered since
    part = df.where("t % 3 <> 1")
    want = windows.rolling_mean_std(part, ["x"], ["t"], window=5, chunk=8).orderBy("t").toPandas()["x_roll_mean_5"]
    got = windows.rolling_mean_std(one.where("t % 3 <> 1"), ["x"], ["t"], window=5, chunk=8).orderBy("t").toPandas()["x_roll_mean_5"]
    np.testing.assert_allclose(got, want)
    # other order
    assert windows.lag_features(one, ["x"], ["x", "t"], [1]).where("x_lag_1 > x").count() == 0
    # a column of the same name that is not ours
    with pytest.raises(ValueError, match="row_idx"):
        windows.rolling_mean_std(df.withColumnRenamed("g", "row_idx"), ["x"], ["t"])


def test_newest_window(spark):
    df = spark.createDataFrame([(g, i, float(i)) for g in (1, 2) for i in range(40 if g == 1 else 10)], "g int, t int, x double")
    rows = {r["g"]: r for r in split.newest_window(df, ["x"], ["t"], ["g"]).collect()}
    assert [s[0] for s in rows[1]["features"]] == [float(i) for i in range(10, 40)] and rows[1]["error"] is None
    assert rows[2]["features"] is None and "10" in rows[2]["error"]
