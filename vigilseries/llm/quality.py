"""Quality selection by importance resampling with hashed n-gram models.

Two generative models are counted in hashed buckets: one from the documents
labelled good (the target), one from all documents (raw). A document's log
weight is the sum of log(target / raw) over all occurrences of its n-grams,
scaled to the average number of words of a document, so long texts do not weigh
more than short ones and repetition weighs as much as it takes up of a text.
Ratios above one, and those within what chance explains (``LEAST_Z`` standard
deviations), count as one, so a long ordinary text cannot make up for words that
good documents never use. A document's own occurrences are taken out of the raw
model when it is scored, so a word that only it repeats does not speak against
it. A sample is drawn by Gumbel top-k: the k largest of log weight plus Gumbel
noise.

The n-grams are the words, their first 4 and 5 bytes, their last 2 bytes, pairs
of neighbours' last 2 bytes, and runs of one word three times over. A word of two
bytes is one n-gram as an end and as its first 5 bytes, counted for both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilseries.llm.arrays import mix, pieces, spans_hash, words
from vigilseries.llm.scratch import drop, store

BUCKETS = 1 << 22
LABELLED = 1 << 20
LEAST_Z = 2.5
FLOOR = -20.0
STEPS = 1000
ROUNDS = 40


@dataclass
class QualityModel:
    """Both counts of the buckets that speak against a document, the target's share of all occurrences, the average
    number of words, and the weight that parts the labelled rows best."""

    buckets: np.ndarray
    raw: np.ndarray
    target: np.ndarray
    share: float
    length: float
    cut: float


def features(column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and (text, bucket) arrays for each kind of n-gram."""
    w = words(column, lower=True)
    owner = w.owner
    tail = spans_hash(w.data, np.maximum(w.starts, w.ends - 2), w.ends)
    kinds = [(owner, w.hashes), (owner, mix(tail + np.uint64(5)))]
    for k in (4, 5):
        kinds.append((owner, mix(spans_hash(w.data, w.starts, np.minimum(w.starts + k, w.ends)) + np.uint64(k))))
    together = owner[1:] == owner[:-1]
    kinds.append((owner[1:][together], mix(tail[:-1] * np.uint64(31) + tail[1:])[together]))
    same = together & (w.hashes[1:] == w.hashes[:-1])
    thrice = np.flatnonzero(same[1:] & same[:-1])
    kinds.append((owner[thrice], mix(np.full(len(thrice), 77, np.uint64))))
    return w.counts, [(o, (v & np.uint64(BUCKETS - 1)).astype(np.int64)) for o, v in kinds]


def _counts(kinds: list[tuple[np.ndarray, np.ndarray]], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and number of occurrences, of the wanted buckets only."""
    key, many = np.unique(np.concatenate([o[hit] * BUCKETS + v[hit] for o, v in kinds for hit in [wanted[v]]]), return_counts=True)
    return key // BUCKETS, key % BUCKETS, many


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Count both models over all documents and set the cut from the labelled ones.

    ``labels`` has ``doc_id``, ``quality`` (1 is good) and ``toxic`` (1 is bad);
    rows with a null are left out, and an id labelled both ways is bad. All
    labelled rows are used up to ``LABELLED``, beyond that the ones with the
    smallest hashes. Raw counts always cover every document. What reaches the
    driver is bounded by ``BUCKETS``. Without good or bad labels nothing counts
    against a document.
    """
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    marked = labels.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), good.alias("good")).where("good IS NOT NULL")
    marked = store(marked.groupBy("id").agg(F.min("good").alias("good")), "labelled")
    if marked.count() > LABELLED:
        marked = marked.orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    rows = texts.join(F.broadcast(marked), "id", "left").select("text", "good")
    counted = rows.mapInArrow(_counter, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counted = store(counted, "counts")
    whole = {r["bucket"]: r for r in counted.where("bucket < 0").collect()}
    share = whole[-1]["target"] / whole[-1]["raw"] if whole and whole[-1]["raw"] else 0.0
    length = whole[-2]["raw"] / whole[-2]["target"] if whole and whole[-2]["target"] else 1.0
    expected = F.col("raw") * F.lit(share)
    z = (F.col("target") - expected) / F.sqrt(expected + 1)
    found = counted.where((F.col("bucket") >= 0) & (z < -LEAST_Z)).select("bucket", "raw", "target").toPandas()
    found = found.sort_values("bucket")
    model = QualityModel(found["bucket"].to_numpy(np.int64), found["raw"].to_numpy(float), found["target"].to_numpy(float), share, length, -np.inf)
    scored = log_weight(rows.where("good IS NOT NULL"), model)
    place = F.floor(F.greatest(F.col("log_weight") / F.lit(length), F.lit(FLOOR)) * STEPS).cast("int")
    bins = scored.groupBy(place.alias("bin"), "good").count().collect()
    drop(marked, counted)
    model.cut = _best_cut([(r["bin"], r["good"], r["count"]) for r in bins]) * length
    return model


def _best_cut(bins: list[tuple[int, int, int]]) -> float:
    """The lowest weight to keep: best mean of the two classes' recalls; keeps all when a class is missing."""
    totals = [sum(n for _, g, n in bins if g == c) for c in (0, 1)]
    if not all(totals):
        return -np.inf
    best, cut = 0.0, -np.inf
    for at in sorted({b for b, _, _ in bins}):
        kept = sum(n for b, g, n in bins if g and b >= at) / totals[1]
        gone = sum(n for b, g, n in bins if not g and b < at) / totals[0]
        if kept + gone > best:
            best, cut = kept + gone, at / STEPS
    return cut


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    n_words, n_texts = 0, 0
    for batch in batches:
        at = 0
        for texts in pieces(batch.column(0), 1 << 20):
            good = batch.column(1).slice(at, len(texts)).fill_null(0).to_numpy(zero_copy_only=False) == 1
            at += len(texts)
            counts, kinds = features(texts)
            owner, bucket = (np.concatenate(x) for x in zip(*kinds, strict=True))
            # Adds in place: memory follows the buckets met, and no array of all buckets is made for a piece.
            np.add.at(raw, bucket, 1)
            np.add.at(target, bucket[good[owner]], 1)
            n_words, n_texts = n_words + int(counts.sum()), n_texts + int((counts > 0).sum())
    used = np.flatnonzero(raw)
    whole = [np.array([-1, -2], np.int32), np.array([raw.sum(), n_words]), np.array([target.sum(), n_texts])]
    yield pa.record_batch([pa.array(x) for x in whole], ["bucket", "raw", "target"])
    for lo in range(0, len(used), 1 << 16):
        part = used[lo: lo + (1 << 16)]
        yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(raw[part]), pa.array(target[part])], ["bucket", "raw", "target"])


def log_weight(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "log_weight") -> DataFrame:
    """All columns and rows, and the log weight of each text (null for null or wordless texts). Nothing is shuffled.

    The texts are taken to be among those the model counted. A column called
    ``name`` is replaced.
    """
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        wanted = np.zeros(BUCKETS, bool)
        wanted[m.buckets] = True
        for batch in batches:
            at = 0
            for texts in pieces(batch.column(where), 1 << 20):
                counts, kinds = features(texts)
                owner, bucket, many = _counts(kinds, wanted)
                place = np.searchsorted(m.buckets, bucket)
                target, expected = m.target[place], np.maximum(m.raw[place] - many, 0) * m.share
                ratio = np.where(target - expected < -LEAST_Z * np.sqrt(expected + 1), np.log((target + 1) / (expected + 1)), 0.0)
                sums = np.bincount(owner, many * ratio, minlength=len(texts)).astype(float)  # of no pairs it counts whole numbers
                sums *= m.length / np.maximum(counts, 1)
                none = counts == 0
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sums, mask=none)], [*part.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def gumbel(*keys: str, seed: int = 11):
    """Standard Gumbel noise that depends on the keys only, so a repeated task draws the same."""
    unit = (F.xxhash64(F.lit(seed), *keys).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(unit))


def importance_sample(docs: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The sampled rows of ``docs`` with ``log_weight`` and ``noisy_weight``.

    ``k`` is by default the number of documents at or above the model's cut, so
    the sample is as large as what the labels call good. Rows without words are
    never drawn. Rows that repeat an id and a text draw alike; a tie at the last
    place is kept whole. ``docs`` must not have the two columns added here.
    """
    model = fit_quality(docs, labels, id_col, text_col)
    drawn = log_weight(docs, model, text_col).withColumn("noisy_weight", F.col("log_weight") + gumbel(id_col))
    seen = store(drawn.where("log_weight IS NOT NULL").select("log_weight", "noisy_weight"), "weights")
    if k is None:
        k = seen.where(F.col("log_weight") >= F.lit(float(model.cut))).count()
    least = kth_largest(seen, "noisy_weight", k)
    drop(seen)
    return drawn.where(F.col("noisy_weight") >= F.lit(float(least)))


def kth_largest(df: DataFrame, col: str, k: int, bins: int = 1024) -> float:
    """The exact ``k``-th largest value by counting ever narrower ranges; ``bins`` counts a round reach the driver."""
    lo, hi, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if k >= n:
        return -np.inf
    if k <= 0:
        return np.inf
    above = 0
    for _ in range(ROUNDS):
        if lo == hi:
            break
        width = (hi - lo) / bins
        place = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
        rows = df.where(F.col(col).between(lo, hi)).groupBy(place.alias("bin")).agg(F.count(col).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
        for r in sorted(rows, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                break
            above += r["n"]
    return lo
