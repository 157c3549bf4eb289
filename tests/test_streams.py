"""Streams against the same rows in one batch."""

import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigilseries.streaming import tails
from vigilseries.streaming.jobs import stream_score_windows


def folder(path, parts):
    path.mkdir()
    for i, part in enumerate(parts):
        file = path / f"{i}.parquet"
        part.to_parquet(file)
        os.utime(file, (1e9 + i, 1e9 + i))  # files are taken oldest first
    return str(path)


def run(spark, tmp_path, parts, schema, **more):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder(tmp_path / "in", parts))
    stream_score_windows(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["v"], ["t"], ["s"], lambda d: d, **more).awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out").toPandas().sort_values("t", ignore_index=True)


def hours(rows):
    return pd.DataFrame(rows, columns=["t", "s", "v"]).assign(t=lambda d: pd.to_datetime(d["t"]).astype("datetime64[us]"))


def test_stream_over_batches_equals_one_batch(spark, tmp_path):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"t": np.arange(300), "s": np.where(rng.random(300) < 0.7, "hot", "cold"), "v": rng.normal(0, 1, 300).round(3)})
    got = run(spark, tmp_path, [pdf.iloc[100 * i:100 * (i + 1)] for i in range(3)], "t long, s string, v double")
    assert len(got) == 300 and list(got["batch_id"]) == [i // 100 for i in range(300)]
    want = pdf.groupby("s")["v"].rolling(30, min_periods=1).mean().reset_index(level=0, drop=True).sort_index()
    np.testing.assert_allclose(got["v_roll_mean_30"], want, atol=1e-9)


def test_stream_forgets_silent_series(spark, tmp_path):
    parts = [hours([("2024-01-01 00:00:00", "old", 1.0)]), hours([("2024-01-01 05:00:00", "new", 2.0)]),
             hours([("2024-01-01 05:10:00", "old", 3.0), ("2024-01-01 05:11:00", "new", 4.0)])]
    got = run(spark, tmp_path, parts, "t timestamp_ntz, s string, v double", ttl="1 hour")
    assert list(got["v_roll_mean_30"]) == [1.0, 2.0, 3.0, 3.0]


def test_stream_with_ttl_leaves_rows_before_the_watermark_alone(spark, tmp_path):
    """Within ``lateness`` a row is placed among the kept rows; beyond it, it meets none and changes none."""
    parts = [hours([("2024-01-01 00:00:00", "x", 1.0), ("2024-01-01 02:00:00", "x", 3.0)]), hours([("2024-01-01 01:55:00", "x", 5.0)]),
             hours([("2024-01-01 00:30:00", "x", 90.0)]), hours([("2024-01-01 02:05:00", "x", 6.0)])]
    got = run(spark, tmp_path, parts, "t timestamp_ntz, s string, v double", ttl="3 hours", lateness="10 minutes")
    assert list(got["v_roll_mean_30"]) == [1.0, 90.0, 3.0, 2.0, 3.75]


def test_stream_scores_late_rows_among_kept_rows(spark, tmp_path):
    """Row 5 arrives late and meets 3 and 4; the next row sees it; a row older than all kept ones is not kept."""
    parts = [pd.DataFrame({"t": [1, 2, 3, 4, 6], "s": "x", "v": [1.0, 2.0, 3.0, 4.0, 6.0]}), pd.DataFrame({"t": [5, 0], "s": "x", "v": [5.0, 90.0]}),
             pd.DataFrame({"t": [7], "s": "x", "v": [7.0]})]
    got = run(spark, tmp_path, parts, "t long, s string, v double", window=3).set_index("t")["v_roll_mean_3"]
    assert got[6] == pytest.approx(13 / 3) and got[5] == 4.0 and got[0] == 90.0 and got[7] == 6.0
    assert len(got) == 8


def test_stream_keeps_types_nulls_and_odd_series(spark, tmp_path):
    big = 2 ** 62 + 1
    first = pd.DataFrame({"t": [1, 2], "s": [None, "é"], "v": [1.0, None], "n": pd.array([big, None], "Int64")})
    second = pd.DataFrame({"t": pd.array([3, 4, None], "Int64"), "s": [None, "é", None], "v": [3.0, 4.0, 8.0], "n": pd.array([None, big, 1], "Int64")})
    stream = spark.readStream.schema("t long, s string, v double, n long").option("maxFilesPerTrigger", 1).parquet(folder(tmp_path / "in", [first, second]))
    stream_score_windows(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["v"], ["t"], ["s"], lambda d: d, window=2).awaitTermination()
    got = {r.t: (r.s, r.n, r.v_roll_mean_2) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: (None, big, 1.0), 2: ("é", None, got[2][2]), 3: (None, None, 2.0), 4: ("é", big, 4.0), None: (None, 1, 8.0)}


def test_stream_touches_only_series_of_the_batch(spark, tmp_path):
    """The state store counts the keys a batch updates."""
    parts = [pd.DataFrame({"t": np.arange(50), "s": [f"s{i}" for i in range(50)], "v": 1.0}), pd.DataFrame({"t": [50, 51], "s": ["s3", "s7"], "v": 2.0})]
    stream = spark.readStream.schema("t long, s string, v double").option("maxFilesPerTrigger", 1).parquet(folder(tmp_path / "in", parts))
    query = stream_score_windows(stream, f"{tmp_path}/out", f"{tmp_path}/ck", ["v"], ["t"], ["s"], lambda d: d)
    query.awaitTermination()
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert [(s["numRowsTotal"], s["numRowsUpdated"]) for s in states[:2]] == [(50, 50), (50, 2)]


def test_newest_rows_per_key_match_sorting():
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({tails.KEY: rng.choice(list("abc"), 200), "t": rng.integers(0, 50, 200), "u": rng.permutation(200)})
    got = tails.newest(pa.Table.from_pandas(pdf, preserve_index=False), ["t", "u"], 7).to_pandas()
    want = pdf.sort_values([tails.KEY, "t", "u"]).groupby(tails.KEY).tail(7).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want)
    assert tails.newest(pa.Table.from_pandas(pdf[:0]), ["t"], 3).num_rows == 0


def test_a_hot_series_reaches_the_state_reduced(spark):
    rows = spark.range(20000, numPartitions=4).select(F.lit("x").alias(tails.KEY), F.col("id").alias("t"))
    sent = rows.mapInArrow(tails._reducer(["t"], 30), f"{tails.KEY} string, {tails.PACKED} binary").collect()
    assert len(sent) == 4 and all(tails.unpack(bytes(r[tails.PACKED])).num_rows == 30 for r in sent)


def test_a_table_streams_from_a_file_and_from_a_folder(spark, tmp_path):
    """Before, a table kept as a folder was an empty stream."""
    from vigilseries.plans import tables
    rows = pd.DataFrame({"doc_id": [1, 2, 3], "text": ["a", None, "c"]})
    (tmp_path / "many").mkdir()
    folder(tmp_path / "many" / "documents.parquet", [rows[:2], rows[2:]])
    (tmp_path / "one").mkdir()
    rows.to_parquet(tmp_path / "one" / "documents.parquet")
    rows.to_parquet(tmp_path / "one" / "documents.parquet.old")
    for kind in ("many", "one"):
        stream = tables.streamed(spark, str(tmp_path / kind), "documents")
        stream.writeStream.option("checkpointLocation", f"{tmp_path}/ck-{kind}").trigger(availableNow=True).format("parquet").start(f"{tmp_path}/out-{kind}").awaitTermination()
        got = spark.read.parquet(f"{tmp_path}/out-{kind}")
        assert {(r.doc_id, r.text) for r in got.collect()} == {(1, "a"), (2, None), (3, "c")} and got.count() == 3


def test_many_series_leave_in_small_messages():
    """Before, all series held at once were packed into one batch, however many there were."""
    n = 5 * tails.MESSAGES // 2
    batch = pa.record_batch({tails.KEY: pa.array([f"k{i:06d}" for i in range(n)] * 2), "t": pa.array(range(2 * n)), tails.TIME: pa.array(range(2 * n), pa.timestamp("us"))})
    made = list(tails._reducer(["t"], 30)(iter([batch])))
    assert [b.num_rows for b in made] == [tails.MESSAGES, tails.MESSAGES, n - 2 * tails.MESSAGES]
    messages = [m for b in made for m in b.to_pylist()]
    assert [m[tails.KEY] for m in messages] == [f"k{i:06d}" for i in range(n)]
    assert all(tails.unpack(m[tails.PACKED])["t"].to_pylist() == [i, n + i] for i, m in enumerate(messages))
    assert [m[tails.TIME] for m in messages] == pa.array(range(n, 2 * n), pa.timestamp("us")).to_pylist()
