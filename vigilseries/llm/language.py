"""Language identification: known words first, then ever shorter character n-grams.

A word is a run of letters, lower-cased. Each language has log frequencies of
the ``WORDS`` most frequent words and of the ``GRAMS`` most frequent character
n-grams (1 to 4, word ends count as a character). A known word speaks through its
own frequencies. An unknown one falls back to its known 4-grams, if it has none
to its 3-grams, and so on; their frequencies are averaged, so it counts as one
word too. A text goes to the language of the largest sum, priors included.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.arrays import cuts, flat, mix, spans_hash
from vigilseries.llm.quality import kth_largest
from vigilseries.llm.scratch import drop, store

WORDS = 100_000
GRAMS = 50_000
LONGEST = 4
SMOOTH = 0.1
UNDETERMINED = "und"
EDGE = ord(" ")


@dataclass
class LanguageModel:
    """Languages and, by sorted hash, log frequencies of words and of n-grams (one row per hash)."""

    languages: list[str]
    prior: np.ndarray
    word_keys: np.ndarray
    word_logs: np.ndarray
    gram_keys: np.ndarray
    gram_logs: np.ndarray


def split_words(text) -> Column:
    """Lower-cased letter runs; an empty string may stand at either end."""
    return F.split(F.lower(text), r"[^\p{L}]+")


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Count words and n-grams of all given documents; rows without text or language teach nothing.

    What reaches the driver is bounded by ``WORDS`` and ``GRAMS`` times the
    number of languages (ties at the last place included).
    """
    able = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in able.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    each = able.select("lang", F.explode(split_words("text")).alias("item")).where("item <> ''")
    counted = store(each.groupBy("lang", "item").agg(F.count(F.lit(1)).alias("n")), "words")
    padded = F.concat(F.lit(" "), "item", F.lit(" "))
    grams = [F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i, n=n: F.substring(padded, i, F.lit(n)))
             for n in range(2, LONGEST + 1)]
    grams.append(F.transform(F.sequence(F.lit(1), F.length("item")), lambda i: F.substring(F.col("item"), i, F.lit(1))))
    spread = counted.select("lang", "n", F.explode(F.filter(F.concat(*grams), lambda g: g != "")).alias("item"))
    gram_counts = store(spread.groupBy("lang", "item").agg(F.sum("n").alias("n")), "grams")
    words = _logs(counted, WORDS, languages, _word_keys)
    found = _logs(gram_counts, GRAMS, languages, _gram_keys)
    drop(counted, gram_counts)
    prior = np.log(np.array([sizes[x] for x in languages], float) / max(sum(sizes.values()), 1))
    return LanguageModel(languages, prior, *words, *found)


def _logs(counted: DataFrame, most: int, languages: list[str], hashed) -> tuple[np.ndarray, np.ndarray]:
    """Keys and log frequencies per language of the most frequent items."""
    total = store(counted.groupBy("item").agg(F.sum("n").alias("total")), "totals")
    least = kth_largest(total, "total", most)
    kept = total.where(F.col("total") >= F.lit(float(least))).select("item")
    size = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    rows = counted.join(kept, "item").toPandas()
    drop(total)
    items, code = np.unique(rows["item"].to_numpy(str), return_inverse=True) if len(rows) else (np.zeros(0, str), np.zeros(0, int))
    table = np.zeros((len(items), len(languages)))
    table[code, [languages.index(x) for x in rows["lang"]]] = rows["n"]
    sums = np.array([size.get(x, 0) for x in languages], float)
    logs = np.log((table + SMOOTH) / (sums + SMOOTH * (len(items) + 1)))
    keys = hashed(pa.array(items.tolist(), pa.string()))
    order = np.argsort(keys)
    return keys[order], logs[order]


def _word_keys(items: pa.Array) -> np.ndarray:
    data, offsets = flat(items)
    return spans_hash(data, offsets[:-1], offsets[1:])


def _code_points(items: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(items)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    begins = (data & 0xC0) != 0x80
    return codes, np.concatenate([[0], np.cumsum(begins)])[offsets]


def _gram_keys(items: pa.Array) -> np.ndarray:
    codes, first = _code_points(items)
    out = np.zeros(len(items), np.uint64)
    for n in range(1, LONGEST + 1):
        rows = np.flatnonzero(np.diff(first) == n)
        out[rows] = _hash_codes(codes, first[rows], n)
    return out


def _hash_codes(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    key = np.full(len(at), n, np.uint64)
    for k in range(n):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + codes[at + k])
    return key


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the wanted keys, -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _fallback(model: LanguageModel, items: pa.Array) -> np.ndarray:
    """Log frequencies of unknown words from the longest n-grams known of each."""
    codes, first = _code_points(items)
    size = np.diff(first)
    codes = np.insert(codes, np.concatenate([first[:-1], first[1:]]), EDGE)
    begin = first[:-1] + 2 * np.arange(len(size))
    # np.insert puts the end of one word before the start of the next: "_a__bc_".
    out = np.zeros((len(size), len(model.languages)))
    open_ = np.ones(len(size), bool)
    for n in range(LONGEST, 0, -1):
        rows = np.flatnonzero(open_)
        inner = n == 1
        many = np.maximum(size[rows] + (0 if inner else 2) - n + 1, 0)
        offsets = np.concatenate([[0], np.cumsum(many)])
        owner = np.repeat(rows, many)
        at = np.arange(offsets[-1]) - np.repeat(offsets[:-1], many) + begin[owner] + inner
        place = _find(model.gram_keys, _hash_codes(codes, at, n))
        hit = place >= 0
        if not hit.any():
            continue
        known = np.bincount(owner[hit], minlength=len(size))
        for lang in range(len(model.languages)):
            sums = np.bincount(owner[hit], model.gram_logs[place[hit], lang], minlength=len(size))
            out[rows, lang] = np.where(known[rows] > 0, sums[rows] / np.maximum(known[rows], 1), out[rows, lang])
        open_ &= known == 0
    return out


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score``.

    ``score`` is the posterior of the predicted language; equal sums go to the
    first language by name. Null texts and texts without a letter, or any text
    when nothing was learned, are ``und`` with score 0. Nothing is shuffled and
    whole texts are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = batch.column(1)
            offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset: found.offset + len(found) + 1].astype(np.int64)
            sums = np.zeros((len(found), len(m.languages)))
            seen = np.zeros(len(found), np.int64)
            items = found.values
            for lo, hi in cuts(items.slice(offsets[0], offsets[-1] - offsets[0]), 1 << 20):
                owner = np.searchsorted(offsets, np.arange(lo, hi) + offsets[0], side="right") - 1
                part = items.slice(offsets[0] + lo, hi - lo)
                some = np.array(pa.compute.binary_length(part)) > 0
                part, owner = part.filter(pa.array(some)), owner[some]
                if not len(part) or not m.languages:
                    continue
                unique, where, back = np.unique(_word_keys(part), return_index=True, return_inverse=True)
                place = _find(m.word_keys, unique)
                logs = m.word_logs[place] if len(m.word_logs) else np.zeros((len(unique), len(m.languages)))
                new = place < 0
                if new.any():
                    logs[new] = _fallback(m, part.take(pa.array(where[new])))
                for lang in range(len(m.languages)):
                    sums[:, lang] += np.bincount(owner, logs[back, lang], minlength=len(found))
                seen += np.bincount(owner, minlength=len(found))
            sums += m.prior
            if m.languages:
                best = sums.argmax(axis=1)
                score = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                names = np.array(m.languages, object)[best]
            else:
                names, score = np.full(len(found), UNDETERMINED, object), np.zeros(len(found))
            names[seen == 0] = UNDETERMINED
            score[seen == 0] = 0.0
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(split_words(F.col(text_col)), F.array().cast("array<string>")).alias("words"))
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Learn from the documents that are not held out and predict all: id, ``held_out``, ``lang_pred``, ``score``."""
    model = fit_languages(docs.where(~held_out(id_col) & F.col(id_col).isNotNull()))
    out = predict_language(docs, model, id_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
