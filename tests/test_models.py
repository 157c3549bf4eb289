"""Neighbours, detectors, evaluation and streams against brute force."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigilseries.functions.scalars import category_map, log_line_parse
from vigilseries.operators import alerts, classifier, detectors, evaluate, neighbours, quantile, text
from vigilseries.sources import artefacts, files


def vectors(spark, x, **more):
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "v": [list(map(float, r)) for r in x], **more})).repartition(3)


def clustered(seed=0, n=240, d=4, copies=80):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.3, (n // 4, d)) for c in (0, 3, 6, 9)])
    return np.concatenate([x, np.repeat(x[:1], copies, 0), np.zeros((2, d))])


def brute(q, c, k, metric, skip_self):
    out = {}
    for i, a in enumerate(q):
        if metric == "cosine":
            norm = np.linalg.norm(a) * np.linalg.norm(c, axis=1)
            d = 1 - np.divide(c @ a, norm, out=np.zeros(len(c)), where=norm > 0)
        else:
            d = np.sqrt(((c - a) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(len(c)), d.round(9))) if not (skip_self and j == i)][:k]
        out[i] = [(j, d[j]) for j in order]
    return out


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("block", [40, 4096])
@pytest.mark.parametrize("skip_self", [False, True])
def test_knn_join_is_exact(spark, metric, block, skip_self):
    x = clustered()
    df = vectors(spark, x)
    got = neighbours.knn_join(df, df, 5, "v", "id", metric, exclude_self=skip_self, block=block).toPandas()
    want = brute(x, x, 5, metric, skip_self)
    assert len(got) == 5 * len(x)
    for i, g in got.groupby("qid"):
        g = g.sort_values("rank")
        np.testing.assert_allclose(g["distance"], [d for _, d in want[i]], atol=1e-7)
        if metric == "euclidean":
            assert list(g["cid"]) == [j for j, _ in want[i]]


def test_knn_votes_ties_and_empty_corpus(spark):
    x = np.array([[1, 0], [1, 0.1], [0, 1], [0.1, 1]])
    corpus = vectors(spark, x, label=["b", "b", "a", "a"])
    query = spark.createDataFrame([(9, [1.0, 1.0]), (8, [1.0, 0.0])], "id long, v array<double>")
    got = {r.qid: (r.label, r.confidence) for r in neighbours.knn_classify(query, corpus, "v", "label", "id", 4).collect()}
    assert got == {9: ("a", 0.5), 8: ("a", 0.5)}
    got = {r.qid: (r.label, r.confidence) for r in neighbours.knn_classify(query, corpus, "v", "label", "id", 2).collect()}
    assert got[8] == ("b", 1.0)
    assert neighbours.knn_classify(query, corpus.where("false"), "v", "label", "id", 2).count() == 0


def test_analyze_logs_row_shape(spark):
    store = vectors(spark, np.eye(3), category=["normal", "timeout", "timeout"], document=["d" * 300, "e", "f"], metadata=["m", "n", "o"]).withColumnRenamed("v", "embedding")
    row = neighbours.analyze_embedded(store.where("id = 0"), store, store, k=3, top_k=2).first()
    assert row["predicted_category"] == "timeout" and row["confidence"] == 0.6667 and abs(row["p_anomaly"] - 2 / 3) < 1e-12
    assert [s["similarity"] for s in row["similar_logs"]] == [1.0, 0.0] and len(row["similar_logs"][0]["document"]) == 200


def test_lof_matches_brute_force(spark):
    x = clustered(1)
    train, test, k = x[::2], np.concatenate([x[1::2], [[50.0] * 4]]), 6
    got = detectors.local_outlier_factor(vectors(spark, train), vectors(spark, test), "v", "id", k).toPandas().set_index("id").sort_index()
    near = brute(train, train, k, "euclidean", True)
    kd = np.array([near[i][-1][1] for i in range(len(train))])
    lrd = np.array([1 / (np.mean([max(kd[j], d) for j, d in near[i]]) + 1e-10) for i in range(len(train))])
    factor = np.array([np.mean([lrd[j] for j, _ in near[i]]) / lrd[i] for i in range(len(train))])
    offset = np.percentile(-factor, 7)
    found = brute(test, train, k, "euclidean", False)
    want = np.array([np.mean([lrd[j] for j, _ in v]) * (np.mean([max(kd[j], d) for j, d in v]) + 1e-10) for v in found.values()])
    np.testing.assert_allclose(got["lof"], want, rtol=1e-6)
    np.testing.assert_allclose(got["anomaly_score"], want + offset, rtol=1e-6, atol=1e-6)
    assert got["is_outlier"].iloc[-1] == 1


def test_isolation_forest_properties(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (1500, 3)), rng.normal(9, 0.2, (15, 3))])
    df = vectors(spark, x)
    model = detectors.fit_isolation_forest(df, "v", "id", n_trees=60)
    again = detectors.fit_isolation_forest(df.repartition(7), "v", "id", n_trees=60)
    got, same = (m.transform(df).toPandas().set_index("id").sort_index() for m in (model, again))
    np.testing.assert_allclose(got["anomaly_score"], same["anomaly_score"])
    raw = got["anomaly_score"] - model.offset
    assert raw.between(0, 1).all() and abs(got["is_outlier"].mean() - 0.07) < 0.01
    assert got["anomaly_score"].iloc[1500:].min() > got["anomaly_score"].iloc[:1500].median()
    assert got["is_outlier"].iloc[1500:].all()


def test_exact_quantile(spark, monkeypatch):
    monkeypatch.setattr(quantile, "SMALL", 50)
    monkeypatch.setattr(quantile, "BINS", 8)
    rng = np.random.default_rng(5)
    x = np.concatenate([np.full(400, 1.25), rng.lognormal(0, 3, 700), [np.nextafter(1.25, 2)] * 60])
    df = spark.createDataFrame(pd.DataFrame({"v": x}))
    for q in (0.0, 0.07, 0.333, 0.5, 0.93, 1.0):
        assert quantile.exact_quantile(df, "v", q) == pytest.approx(np.percentile(x, 100 * q), rel=1e-12)
    assert quantile.exact_quantile(df.where("false"), "v", 0.5) is None


def test_threshold_sweep_matches_loop(spark):
    rng = np.random.default_rng(8)
    grid = np.linspace(0.01, 0.99, 200)
    s = np.concatenate([rng.random(500), grid, [0.0, 1.0]])  # scores lying exactly on the grid
    y = (rng.random(len(s)) < s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    best, best_f1 = 0.5, -1.0
    for t in grid:
        p = s >= t
        tp = (p & (y == 1)).sum()
        f1 = 2 * tp / (p.sum() + y.sum())
        if f1 > best_f1:
            best, best_f1 = t, f1
    row = evaluate.optimise_threshold(df, "s", "y").first()
    assert row["threshold"] == pytest.approx(best, abs=1e-12) and row["f1"] == pytest.approx(best_f1)
    pairs = s[y == 1][:, None] - s[y == 0][None, :]
    assert row["roc_auc"] == pytest.approx((pairs > 0).mean() + (pairs == 0).mean() / 2)


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.2), (0, 0, 0.4)], "y int, p int, s double")
    assert tuple(evaluate.binary_metrics(df, "y", "p", "s").first()) == (0.0, 0.0, 0.0, 0.0)
    assert [r["count"] for r in evaluate.confusion_matrix(df, "y", "p").orderBy("actual", "predicted").collect()] == [2, 0, 0, 0]


def test_report_counts_labels_seen_on_one_side(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "y string, p string")
    got = {r["label"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert got["b"]["support"] == 0 and got["b"]["recall"] == 0.0 and got["c"]["f1"] == 0.0
    assert got["accuracy"]["f1"] == pytest.approx(1 / 3) and got["macro avg"]["support"] == 3


def test_reconcile_counts_unmatched_rows(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, 3.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.00001), (None, 3.0), (4, 9.0)], "k int, v double")
    row = evaluate.reconcile_outputs(a, b, ["k"], ["v"]).first()
    assert (row["only_a"], row["only_b"], row["ok"]) == (1, 1, True)


def test_overlay_orders_and_cuts_episodes(spark, monkeypatch):
    monkeypatch.setattr(alerts, "CHUNK_ROWS", 7)
    df = spark.range(60).selectExpr("id AS t", "10.0D AS a", "CAST(NULL AS DOUBLE) AS b", "0 AS is_anomaly", "'none' AS anomaly_type")
    eps = spark.createDataFrame([
        (5, 30, 0, "spike", "a", "multiply", 100.0, 0.0, 500.0), (10, 2, 0, "late", "a", "multiply", 0.5, None, None),
        (11, 0, 1, "fixed", "b", "set", 3.0, None, None), (58, 9, 2, "tail", "a", "set", -1.0, None, None),
    ], "start_idx long, length long, ord int, kind string, metric string, op string, value double, lo double, hi double")
    got = {r.t: (r.a, r.b, r.is_anomaly, r.anomaly_type) for r in alerts.overlay_episodes(df, eps, ["t"], ["a", "b"]).collect()}
    assert got[4] == (10.0, None, 0, "none") and got[5] == (500.0, None, 1, "spike") and got[35] == (500.0, None, 1, "spike") and got[36][2] == 0
    assert got[10] == (250.0, None, 1, "late") and got[11] == (250.0, 3.0, 1, "fixed") and got[59] == (-1.0, None, 1, "tail")
    assert len(got) == 60


def test_unified_alert_defaults_to_no_log_signal(spark):
    scores = spark.createDataFrame([(1, 0.5), (2, 1.0)], "step int, p_seq double")
    logs = spark.createDataFrame([(1, 0.2), (1, 0.9)], "step int, p_anomaly double")
    got = {r.step: r.alert_score for r in alerts.unified_alert(scores, logs, "step").collect()}
    assert got[1] == pytest.approx(0.7 * 0.5 + 0.3 * 0.9) and got[2] == pytest.approx(0.7)


def test_csv_faults(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('timestamp, latency_ms ,cpu_util_pct,is_anomaly,note\n2024-01-01 00:00:00,1.5,bad,0,"a,b"\n\n2024-01-01 00:05:00,,nan,1\n2024-01-01 00:10:00,12abc,3,1,x,extra\n')
    rows = files.read_telemetry_csv(spark, str(path)).orderBy("timestamp").collect()
    assert [(r["latency_ms"], r["cpu_util_pct"], r["is_anomaly"], r["note"]) for r in rows] == [(1.5, None, 0, "a,b"), (None, None, 1, None), (None, 3.0, 1, "x")]


def test_log_lines_and_categories(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:05 | ERROR | E1 | a | b",), ("broken",), (None,)], "line string")
    got = df.select(*[c.alias(n) for n, c in log_line_parse(F.col("line")).items()]).collect()
    assert got[0]["message"] == "a | b" and got[0]["log_ts"].second == 5 and got[1]["severity"] is None and len(got) == 3
    kinds = spark.createDataFrame([("latency_spike", 1), ("latency_spike", 0), ("odd", 1), (None, 1)], "k string, y int")
    assert [r[0] for r in kinds.select(category_map(F.col("k"), F.col("y"))).collect()] == ["timeout", "normal", "normal", "normal"]


def test_stratified_split_keeps_shares(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'rare' WHEN id = 1 THEN NULL ELSE 'usual' END AS y")
    got = text.stratified_split(df, "id", "y").groupBy("y").agg(F.count_if(F.col("split") == "test").alias("t"), F.count("*").alias("n")).collect()
    assert {(r.y, r.t, r.n) for r in got} == {("rare", 20, 100), ("usual", 180, 899), (None, 0, 1)}


def test_stratified_split_moves_no_payload(spark):
    df = spark.range(4000).selectExpr("id", "CAST(id % 3 AS STRING) AS y", "repeat('x', 50) AS payload")
    plan = text.stratified_split(df, "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_stratified_split_matches_sorting_whatever_the_digits(spark, monkeypatch):
    import hashlib
    rng = np.random.default_rng(7)
    ids, y = rng.permutation(3000), rng.choice(["a", "b", "c"], 3000, p=[0.9, 0.099, 0.001])
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "y": y}))
    want = {}
    for c in "abc":
        own = sorted((int(i) for i in ids[y == c]), key=lambda i: (hashlib.md5(f"{i}:42".encode()).hexdigest(), i))
        cut = int(len(own) * 0.3 + 0.5)
        want |= {i: "test" if n < cut else "train" for n, i in enumerate(own)}
    for digits in (1, 3):
        monkeypatch.setattr(text, "DIGITS", digits)
        assert {r.id: r.split for r in text.stratified_split(df, "id", "y", 0.3).collect()} == want


def test_stratified_split_keeps_copies_together(spark):
    rows = [(1, "a")] * 6 + [(i, "a") for i in range(2, 16)] + [(None, "b"), (None, "b"), (None, None)]
    got = text.stratified_split(spark.createDataFrame(rows, "id long, y string"), "id", "y", 0.5).toPandas()
    assert len(got) == 23 and got.fillna(-1).groupby(["id", "y"])["split"].nunique().max() == 1
    assert (got[got.y == "a"]["split"] == "test").sum() <= 10 and set(got[got.y == "b"]["split"]) == {"train"}
    assert text.stratified_split(spark.createDataFrame([], "id long, y string"), "id", "y").count() == 0


def test_area_of_many_scores_with_ties_and_nulls(spark, monkeypatch):
    from vigilseries.operators import layout
    monkeypatch.setattr(layout, "CHUNK_ROWS", 16)
    rng = np.random.default_rng(11)
    s = np.concatenate([rng.random(1500), rng.choice([0.25, 0.5], 400)])
    y = (rng.random(len(s)) < s).astype(int)
    rows = [(float(a), int(b)) for a, b in zip(s, y)] + [(None, 1), (0.3, None)]
    df = spark.createDataFrame(rows, "s double, y int")
    pairs = s[y == 1][:, None] - s[y == 0][None, :]
    assert evaluate.roc_auc(df, "s", "y") == pytest.approx((pairs > 0).mean() + (pairs == 0).mean() / 2, abs=1e-12)
    assert evaluate.roc_auc(df.where("y = 1"), "s", "y") == 1.0 and evaluate.roc_auc(df.where("false"), "s", "y") == 0.0


def test_metrics_read_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf
    df = spark.range(1000).selectExpr("id / 1000 AS s", "CAST(id % 3 = 0 AS INT) AS y", "CAST(id > 500 AS INT) AS p").mapInPandas(count, "s double, y int, p int")
    for run in (lambda: evaluate.binary_metrics(df, "y", "p", "s"), lambda: evaluate.optimise_threshold(df, "s", "y")):
        seen.value = 0
        run().collect()
        assert seen.value == 1000


def test_window_classifier_round_trip(spark, tmp_path):
    rng = np.random.default_rng(2)
    y = (rng.random(400) < 0.2).astype(int)
    rows = [(i, (rng.normal(0, 1, (5, 2)) + 2 * y[i]).tolist(), int(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, features array<array<double>>, label int")
    train, val, test = df.where("id < 250"), df.where("id >= 250 AND id < 320"), df.where("id >= 320")
    for kind in ("logreg", "gbt"):
        model = classifier.fit_window_classifier(train, val, kind, 8)
        assert model.metrics["f1"] > 0.8 and model.feature_count == 2 and model.window == 5
        artefacts.save_model(model, spark, f"{tmp_path}/{kind}")
        loaded = artefacts.load_model(spark, f"{tmp_path}/{kind}")
        a, b = (m.transform(test).orderBy("id").toPandas()["anomaly_score"] for m in (model, loaded))
        np.testing.assert_allclose(a, b)
        assert artefacts.model_info(spark, f"{tmp_path}/{kind}").first()["window_size"] == 5
    short = spark.createDataFrame([(1, [[0.0, 0.0]] * 4), (2, [[9.0, 9.0], *[[0.0, 0.0]] * 5])], "id long, features array<array<double>>")
    got = {r.id: r for r in classifier.score_windows(short, model).collect()}
    assert got[1]["anomaly_score"] is None and got[1]["error"].endswith("has 4") and got[2]["error"] is None and got[2]["anomaly_score"] is not None


def test_boosting_reads_windows_in_bounded_tasks(spark, monkeypatch):
    """Windows that take few bytes in a file are bounded by rows; before, one task read them all."""
    from vigilseries.operators import classifier
    monkeypatch.setattr(classifier, "FILE_ROWS", 100)
    seen = []

    def boosted(ready, *_):
        seen.extend(ready.rdd.glom().map(len).collect())
        raise StopIteration
    monkeypatch.setattr(classifier, "_boosted", boosted)
    df = spark.range(3000, numPartitions=1).select(F.array(F.array(F.lit(1.0)), F.array(F.lit(2.0))).alias("features"), (F.col("id") % 2).cast("int").alias("label"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with pytest.raises(StopIteration):
        classifier.fit_window_classifier(df, df.limit(10), "gbt")
    assert sum(seen) == 3010 and max(seen) <= 400
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
