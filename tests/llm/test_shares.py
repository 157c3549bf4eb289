"""Shards, target-distribution resampling and whitening."""

import math
import random
import zlib
from bisect import bisect_right
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from vigilseries.llm import radix, shards
from vigilseries.llm.bidiagonal import dqds, right_singular
from vigilseries.llm.radix import radix_places
from vigilseries.llm.resample import drawn_documents, resample
from vigilseries.llm.shards import assign_shards, write_shards
from vigilseries.llm.whitening import whiten, whitened_vectors

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def least_capacity(sizes, n):
    """Smallest largest shard of a contiguous cut, by dynamic programming over the cuts."""
    sums = [0]
    for s in sizes:
        sums.append(sums[-1] + s)
    best = [sums[i] for i in range(len(sums))]
    for _ in range(n - 1):
        best = [min(max(best[j], sums[i] - sums[j]) for j in range(i + 1)) for i in range(len(sums))]
    return best[-1]


def sizes_in_order(rows):
    groups = {}
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        groups.setdefault(x or "", []).append(1 + len((x or "").encode()))
    return [sum(v) for v in groups.values()]


@pytest.mark.parametrize("points", [1 << 14, 40])
def test_shards_match_brute_force(spark, monkeypatch, points):
    monkeypatch.setattr(shards, "POINTS", points)
    rng = random.Random(6)
    for n, hot in ((5, 0), (16, 0), (7, 60), (4, 300)):
        texts = ["é" * rng.randrange(60) for _ in range(90)]
        rows = [(i, rng.choice(texts)) for i in range(160)] + [(200 + i, "one text of many copies") for i in range(hot)]
        out = assign_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), n).collect()
        assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == sorted((i, 1 + len(x.encode()), zlib.crc32(x.encode())) for i, x in rows)
        text, home, slots, held = dict(rows), {}, {}, Counter()
        for r in out:
            assert home.setdefault(text[r["doc_id"]], r["shard"]) == r["shard"] and r["law"] == "bytes" and r["grown_shard"] is None
            slots.setdefault(r["shard"], []).append(r["slot"])
            held[r["shard"]] += r["size"]
        assert set(home.values()) <= set(range(n)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
        assert max(held.values()) == least_capacity(sizes_in_order(rows), n)
        firsts = [home[x] for x in dict.fromkeys(x for _, x in rows)]
        assert firsts == sorted(firsts)  # contiguous in the order of the groups
        if hot == 300:
            assert sorted(held.values())[0] > 0  # slack is dealt out, no shard stays empty


def test_known_sums_find_the_exact_capacity():
    rng = random.Random(1)
    for _ in range(60):
        sizes = [rng.choice([1, 2, 50, rng.randrange(1, 400)]) for _ in range(rng.randrange(1, 60))]
        sums = np.cumsum(sizes)
        n, known = rng.randrange(1, 9), shards.KnownSums(int(sums[-1]), len(sums))
        while (least := known.least(n, False)) != (most := known.least(n, True)):
            found = []
            for lo, hi in known.undecided(n, least, most):
                inside = [(int(s), k + 1) for k, s in enumerate(sums) if lo < s <= hi]
                found += rng.sample(inside, min(2, len(inside))) + inside[len(inside) // 2:][:1]
            known.add(found)
        cuts = known.even_cuts(n, most)
        assert most == least_capacity(sizes, n) and cuts[-1] == sums[-1] and max(np.diff([0, *cuts])) <= most and set(cuts) <= {0, *sums.tolist()}


def test_shards_odd_rows(odd_docs, no_docs, tmp_path):
    out = assign_shards(odd_docs, 4)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and out.count() == odd_docs.count()
    empty = out.where("size = 1").collect()
    assert len(empty) == 2 and {r["text_crc32"] for r in empty} == {0} and len({r["shard"] for r in empty}) == 1
    assert len({(r["shard"], r["slot"]) for r in out.collect()}) == odd_docs.count()
    assert assign_shards(no_docs).count() == 0 and {r["shard"] for r in assign_shards(odd_docs, 1).collect()} == {0}
    facts = {r["shard"]: (r["rows"], r["bytes"]) for r in write_shards(odd_docs, str(tmp_path / "out"), 3, file_bytes=2000).collect()}
    back = odd_docs.sparkSession.read.parquet(str(tmp_path / "out"))
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == {s: n for s, (n, _) in facts.items()}
    assert back.drop("shard").exceptAll(odd_docs.select(*back.drop("shard").columns)).count() == 0
    write_shards(odd_docs.withColumns({"shard": F.lit(77), "key": F.lit("own"), "size": F.lit("own")}), str(tmp_path / "again"), 3)
    again = odd_docs.sparkSession.read.parquet(str(tmp_path / "again"))
    assert again.where("shard > 2 OR key <> 'own' OR size <> 'own'").count() == 0 and again.count() == odd_docs.count()


@pytest.mark.parametrize("bits", [12, 2])
def test_radix_places(spark, monkeypatch, bits):
    monkeypatch.setattr(radix, "DIGIT_BITS", bits)
    rng = random.Random(4)
    rows = [(rng.randrange(9), rng.choice([5, 700, rng.randrange(1 << 12)]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(5, "i")
    got = radix_places(df, [(F.col("a"), 4), (F.col("b"), 12)]).orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(400)) and [(r["a"], r["b"]) for r in got] == sorted((a, b) for a, b, _ in rows)
    assert {r["i"] for r in got} == set(range(400)) and radix_places(df.limit(0), [(F.col("a"), 4)]).count() == 0
    with pytest.raises(ValueError, match="overwritten"):
        radix_places(df.withColumn("place", F.lit(1)), [(F.col("a"), 4)])


def brute_resample(rows, target, percent=25, least=20):
    def crcs(x):
        w = WORD.findall((x or "").translate({c: c + 32 for c in range(65, 91)}))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in [*w, *map(" ".join, zip(w, w[1:], strict=False))]]
    found = [(i, *crcs(x)) for i, x in rows]
    raw, wanted = Counter(k for _, _, f in found for k in f), Counter(k for x in target for k in crcs(x)[1])
    s, t = (float(sum(c.values()) + 10000) for c in (raw, wanted))
    gain = {k: math.floor(1000 * math.log((wanted[k] + 1.0) * s / ((raw[k] + 1.0) * t))) for k in raw}
    out = []
    for i, n, f in found:
        weight = sum(gain[k] for k in f) // len(f) if f else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = able[: len(able) * percent // 100]
    place = {id(r): k + 1 for k, r in enumerate(drawn)}
    return sorted(((r[0], r[2], r[3], r[4], place.get(id(r))) for r in out), key=str)


def test_resample_matches_brute_force(spark, corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    rows += [(1 << 40, None), (-3, ""), (7000, "É" * 90 + " a" * 30 + " " + "z" * 300), (None, "x1 ünder Ab " * 9), (7001, "\x00a_b-c\x7f" * 30), (-3, "w " * 25)]
    target = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()] + [None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = resample(docs, spark.createDataFrame([(x,) for x in target], "text string"), 40)
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in out.collect()), key=str) == brute_resample(rows, target, 40)
    kept = drawn_documents(docs, out).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(r["doc_id"] for r in out.where("rank IS NOT NULL AND doc_id IS NOT NULL").collect())


@pytest.mark.parametrize("ids", [[5, 6, None], [-(1 << 63), (1 << 63) - 1, 0, None], [None, None]])
def test_resample_orders_any_ids(spark, ids):
    rows = [(i, "same " * 30) for i in ids]
    out = resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "text string"), 100).collect()
    assert sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in out), key=str) == brute_resample(rows, [], 100)


def test_resample_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([("same text here",), (None,)], "text string")
    out = resample(odd_docs, target, 100, 1)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "key", "rank"] and out.count() == odd_docs.count()
    ranks = [r["rank"] for r in out.collect() if r["rank"]]
    assert sorted(ranks) == list(range(1, len(ranks) + 1)) and out.where("n_features = 0 AND (weight <> 0 OR rank IS NOT NULL)").count() == 0
    assert resample(no_docs, target).count() == 0 and resample(odd_docs, target, 0).where("rank IS NOT NULL").count() == 0


@pytest.mark.parametrize("kind", ["plain", "graded", "constant", "repeated", "few", "clusters"])
def test_right_singular_vectors(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 24))
    if kind == "graded":
        x = x * 10.0 ** -np.linspace(0, 9, 24)
    elif kind == "constant":
        x[:, 5] = x[:, 9] = 0.0
    elif kind == "repeated":
        x = np.hstack([x, x])
    elif kind == "few":
        x = x[:7]
    elif kind == "clusters":
        x = np.linalg.qr(x)[0] * (1 + 1e-9 * rng.normal(size=24)) @ np.linalg.qr(rng.normal(size=(24, 24)))[0]
    values, vectors = right_singular(np.linalg.qr(x, mode="r"))
    cov = x.T @ x
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12 and (np.diff(values) <= 0).all()
    assert np.abs(cov @ vectors - vectors * values).max() < 1e-13 * values[0]
    if kind == "graded":  # small values to relative accuracy, which the covariance matrix would lose
        exact = np.linalg.svd(x, compute_uv=False) ** 2
        assert (np.abs(values - exact) <= 1e-9 * exact).all()


def test_dqds_to_high_relative_accuracy():
    a, b = 10.0 ** -np.arange(12), 0.5 * 10.0 ** -np.arange(11)
    product = float(np.prod(a * a))
    found = sorted(dqds(a, b))
    assert abs(np.prod(found) / product - 1) < 1e-12  # the determinant, over 132 orders of magnitude


def by_numpy(rows, k=32):
    ids = [i for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)], dtype=object)
    n, s = len(x), x.sum(0)
    apart = x * n - s
    centred = apart.astype(float) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return ids, n, [int(sum(c * c for c in r)) for r in apart], e[::-1][:k], (centred @ v[:, ::-1][:, :k]) / np.sqrt(e[::-1][:k]), e.sum()


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=40) * np.linspace(4, 1, 40)).tolist()) for i in range(300)]
    rows += [(900, None), (901, [1.0] * 39 + [None]), (902, [float("nan")] * 40), (903, [float("inf")] * 40), (904, []), (3, rows[3][1]), (None, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).withColumn("component", F.lit("own")).repartition(5)
    got = {}
    for r in whiten(df).collect():
        got.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    ids, n, deviation, e, whitened, total = by_numpy(rows)
    assert n == 302 and len(got) == 301  # one row twice
    signs = None
    for i, d, w in zip(ids, deviation, whitened, strict=True):
        mine = sorted(got[i, d], key=lambda r: r["component"])[:: 2 if i == 3 else 1]
        assert [r["component"] for r in mine] == list(range(1, 33)) and {r["n"] for r in mine} == {n} and max(r["identity_error"] for r in mine) < 1e-10
        v = np.array([r["whitened"] for r in mine])
        signs = np.sign(v * w) if signs is None else signs
        assert np.abs(v * signs - w).max() < 1e-9 and np.abs(np.array([r["explained"] for r in mine]) * total / e - 1).max() < 1e-10
    vectors = whitened_vectors(df).collect()
    assert len(vectors) == n and {len(r["vector"]) for r in vectors} == {32}


def test_whitening_odd_rows(spark):
    def of(*vectors):
        return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    assert whiten(of().limit(0)).count() == 0 and whiten(of([1.0, 2.0])).count() == 0 and whiten(of([1.0], [1.0])).count() == 0
    flat = whiten(of([1.0, 2.0, 3.0], [2.0, 2.0, 3.0], [4.0, 2.0, 3.0])).collect()  # one direction has variance
    assert len(flat) == 3 and {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12
    assert abs(sum(r["whitened"] ** 2 for r in flat) / 3 - 1) < 1e-12
    far = whiten(of([1e7, 0.0], [-1e7, 1.0], [0.0, 5.0])).collect()  # squares beyond doubles stay exact
    x = [[math.floor(64 * float(np.float32(c))) for c in v] for v in ([1e7, 0.0], [-1e7, 1.0], [0.0, 5.0])]
    assert {r["deviation"] for r in far} == {sum((3 * v[d] - sum(w[d] for w in x)) ** 2 for d in range(2)) for v in x}
    with pytest.raises(ValueError, match="together"):
        whiten(of([1.0], [1.0, 2.0]))
