"""Tokens, pieces, languages, quality, chat and top-k."""

import random
import time
from collections import Counter
from itertools import accumulate
from math import floor, log, sqrt
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from llm.conftest import ODD
from vigilseries.llm import pieces as sp
from vigilseries.llm.chat import conversations, echo_pairs, format_preferences
from vigilseries.llm.language import fit_languages, held_out, identify_languages, predict_language
from vigilseries.llm.quality import gumbel, importance_sample, kth_largest
from vigilseries.llm.tokens import count_tokens
from vigilseries.llm.topk import integer_vectors, top_k

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
STRANGE = ["it's we'll 's ''s \n's x'tabc a'S'", "<|endoftext|>", "x <|endoftext|> y<|endoftext|><|endo", "日本語 ١٢٣ ½ ² é̀ 🙂🙂 ok　x", "a" * 700,
           "▁x ▁▁", "ＡＢ①é", "\x00\x01 <s> </s> <unk> <0x0A>", " " * 40 + "x", "ab" * 400]


def test_token_counts_equal_the_library(spark, corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.select("doc_id", "text").collect()] + [(10**6 + i, x) for i, x in enumerate([*ODD, *STRANGE])]
    model = Tokenizer.from_file(BPE)
    want = {i: (len((x or "").encode()), len(model.encode(x or "", add_special_tokens=False).ids)) for i, x in rows}
    got = count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), Path(BPE).read_text(), limit=100).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)


def test_token_counts_odd_rows(odd_docs, no_docs):
    out = count_tokens(odd_docs, Path(BPE).read_text())
    assert out.count() == odd_docs.count() and out.where("doc_id = 1").first()["n_tokens"] == 0
    assert count_tokens(no_docs, Path(BPE).read_text()).count() == 0


@pytest.mark.parametrize("dictionary", [1 << 20, 200])
def test_pieces_equal_the_library_and_round_trip(spark, corpus, monkeypatch, dictionary):
    monkeypatch.setattr(sp, "DICTIONARY", dictionary)
    rows = [(r["doc_id"], r["text"]) for r in corpus.where("doc_id < 80").select("doc_id", "text").collect()]
    rows += [(10**6 + i, x) for i, x in enumerate([*ODD, *STRANGE])]
    model, table = SentencePieceProcessor(model_file=MODEL), sp.load_pieces(MODEL)
    for r in sp.decode(sp.encode(spark.createDataFrame(rows, "doc_id long, text string"), table), table).collect():
        ids = model.encode(r["text"] or "")
        assert r["ids"] == ids and r["decoded"] == model.decode(ids) == (r["text"] or "").replace("▁", " ")


@pytest.mark.parametrize("text", [" " * 100_000, "ab" * 50_000, "qzjkvw" * 9_000, "." * 50_000 + "=" * 50_000])
def test_long_runs_are_merged_quickly(text):
    alone, started = sp.InPlace(sp.load_pieces(MODEL)), time.perf_counter()
    ids = alone.ids("▁" + text.replace(" ", "▁"))
    assert time.perf_counter() - started < 5 and ids == SentencePieceProcessor(model_file=MODEL).encode(text)


def test_pieces_keep_columns_of_any_name(odd_docs):
    table = sp.load_pieces(MODEL)
    docs = odd_docs.withColumns({"_units": F.lit("own"), "ids": F.lit("theirs")})
    out = sp.decode(sp.encode(docs, table), table, name="component")
    assert out.count() == docs.count() and out.select("_units").distinct().collect() == [("own",)]
    assert dict(out.dtypes)["ids"] == "array<int>" and dict(out.dtypes)["component"] == "string"


def test_unigram_fold_matches_brute_force(spark):
    rng = random.Random(4)
    rows = [(p, i, -rng.random() * 9) for i, p in enumerate(["▁", "a", "b", "▁a", "ab", "ba", "aa", "aba", "▁ab", "bb", "abb"])]
    table = sp.Pieces(rows, None, 99, False, [])
    units = sorted({"▁" + "".join(rng.choices("abc", k=rng.randrange(12))) for _ in range(60)} | {"ab" * 90})
    score = {p: (s, i) for p, i, s in rows}

    def best(u):
        at = [(0.0, [])]
        for hi in range(1, len(u) + 1):
            found = []
            for lo in range(hi):
                s, i = score.get(u[lo:hi], (min(s for _, _, s in rows) - sp.UNKNOWN_COST, 99) if hi == lo + 1 else (None, None))
                if s is not None:
                    found.append((at[lo][0] + s, -lo, [*at[lo][1], i]))
            at.append(max(found)[::2])
        return at[-1][1]
    got = {r["unit"]: r["ids"] for r in sp.encode_units(spark.createDataFrame([(u,) for u in units], "unit string"), table).collect()}
    assert got == {u: best(u) for u in units}


def test_pieces_odd_rows(odd_docs, no_docs):
    table = sp.load_pieces(MODEL)
    out = sp.encode(odd_docs, table)
    assert out.columns == [*odd_docs.columns, "ids"] and out.count() == odd_docs.count() and out.where("doc_id = 1").first()["ids"] == []
    assert sp.encode(no_docs, table).count() == 0


def test_languages_on_held_out_documents(corpus):
    out = identify_languages(corpus).join(corpus.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(out) == corpus.count() and out["score"].between(0, 1).all()
    held = out[out["held_out"]]
    assert len(held) > 20 and (held["lang"] == held["lang_pred"]).mean() > 0.97


def test_languages_odd_rows(odd_docs, no_docs, corpus):
    model = fit_languages(corpus)
    got = {r["doc_id"]: r for r in predict_language(odd_docs, model).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and got[1]["score"] == 0.0 and got[8]["lang_pred"] == "en"
    assert predict_language(no_docs, model).count() == 0
    nothing = predict_language(odd_docs, fit_languages(no_docs)).collect()
    assert len(nothing) == odd_docs.count() and {r["lang_pred"] for r in nothing} == {"und"}
    assert odd_docs.where("doc_id IS NULL").select(held_out()).first()[0] is False


def test_quality_keeps_good_and_drops_marked(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        w = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randint(5, 80))]
        bad = i % 5 == 0
        if bad:
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "awful"]))
        rows.append((i, " ".join(w), "x"))
        if i % 2:
            labels.append((i, 1, int(bad)))
    rows += [(9000, None, "x"), (9001, "", "x"), (None, "w1 w2", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, good string")
    marks = spark.createDataFrame([*labels, (1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = importance_sample(docs, marks)
    assert got.columns == [*docs.columns, "log_weight", "noisy_weight"]
    kept = {r["doc_id"] for r in got.collect()}
    assert not kept & {9000, 9001} and kept == {r["doc_id"] for r in importance_sample(docs.repartition(5), marks).collect()}
    clean = [i for i in range(900) if i % 5]
    assert sum(i in kept for i in clean) > 0.98 * len(clean) and sum(i in kept for i in range(0, 900, 5)) < 20
    assert importance_sample(docs, marks, k=10).count() == 10
    assert dict(importance_sample(docs.withColumn("log_weight", F.lit("own")), marks, k=10).dtypes)["log_weight"] == "double"
    assert importance_sample(docs, marks.limit(0)).count() == 901 and importance_sample(docs.limit(0), marks).count() == 0


def test_quality_drops_repetition_of_ordinary_words(spark):
    rng = random.Random(12)
    usual = [f"{rng.choice('bdfgklm')}{rng.choice('aeiou')}{rng.choice('nprst')}{rng.choice('aeiou')}" for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = [usual[int(rng.paretovariate(0.6)) % 300] for _ in range(rng.randint(30, 200))]
        if i % 6 == 0:
            w = [x for x in w[:5] for _ in range(40)]
        elif i % 3 == 0:
            w[7:7] = [w[7]] * 2  # a word three times is no junk
        rows.append((i, " ".join(w)))
        if i % 5 < 2:
            labels.append((i, int(i % 6 > 0), 0))
    rows.append((601, " ".join([*(rng.choice(usual) for _ in range(200)), *["zyxowarn"] * 2, *(x for w in usual[:20] for x in (w, "zyxowarn"))])))  # its own word, often
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in importance_sample(docs, marks).collect()}
    assert not kept & set(range(0, 600, 6)) and len(kept & {i for i in range(600) if i % 6}) > 0.97 * 500 and 601 in kept


def ngrams(text):
    w = (text or "").lower().split()
    tails = [(5, x[-2:]) for x in w]  # ends and first 5 bytes share their buckets
    return len(w), Counter([("word", x) for x in w] + tails + [(k, x[:k]) for x in w for k in (4, 5)] + list(zip(tails, tails[1:]))
                           + ["thrice" for a, b, c in zip(w, w[1:], w[2:]) if a == b == c])


def test_quality_sample_matches_brute_force(spark):
    rng = random.Random(5)
    vocabulary = sorted({"".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(70)})
    texts, labels = {}, {}
    for i in range(150):
        pool = (vocabulary[:45], vocabulary[30:], vocabulary)[i % 3]
        texts[i] = " ".join(x for _ in range(rng.randint(0, 50)) for x in [rng.choice(pool)] * rng.choice([1, 1, 1, 1, 3]))
        if i % 3 < 2 and i % 5:
            labels[i] = (1 - i % 3, int(i % 3 == 1 and i % 2))
    raw, target, words, good = Counter(), Counter(), {}, {i for i, x in labels.items() if x == (1, 0)}
    for i, x in texts.items():
        words[i], own = ngrams(x)
        raw += own
        target += own if i in good else Counter()
    share, length = target.total() / raw.total(), sum(words.values()) / sum(n > 0 for n in words.values())

    def far(key, less=0):
        expected = (raw[key] - less) * share
        return (target[key] - expected) / sqrt(expected + 1) < -2.5, expected
    weight = {}
    for i, x in texts.items():
        own = {k: (n, *far(k, n)) for k, n in ngrams(x)[1].items() if far(k)[0]}
        if words[i]:
            weight[i] = sum(n * log((target[k] + 1) / (e + 1)) for k, (n, hit, e) in own.items() if hit) * length / words[i]
    step = {i: floor(max(x / length, -20) * 1000) for i, x in weight.items()}
    told = [i for i in labels if i in step]
    recall = {b: sum(step[i] >= b for i in told if i in good) / sum(i in good for i in told)
              + sum(step[i] < b for i in told if i not in good) / sum(i not in good for i in told) for b in sorted({step[i] for i in told})}
    cut = max(recall, key=recall.get) / 1000 * length
    k = sum(x >= cut for x in weight.values())
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    noise = {r.doc_id: r.g for r in docs.select("doc_id", gumbel("doc_id").alias("g")).collect()}
    want = sorted(weight, key=lambda i: -weight[i] - noise[i])[:k]
    got = {r.doc_id: r for r in importance_sample(docs, spark.createDataFrame([(i, *x) for i, x in labels.items()], "doc_id long, quality int, toxic int")).collect()}
    assert 20 < k < 140 and sorted(got) == sorted(want)
    for i, r in got.items():
        assert r.log_weight == pytest.approx(weight[i], abs=1e-9) and r.noisy_weight == pytest.approx(weight[i] + noise[i], abs=1e-9)


def test_kth_largest(spark):
    values = [float(x * x % 37) for x in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert all(kth_largest(df, "v", k, 4) == sorted(values)[-k] for k in (1, 7, 100, 199)) and kth_largest(df, "v", 200) == float("-inf")


def test_preferences(spark):
    turns = spark.createDataFrame([
        (1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|>"), (1, 2, "assistant", "hello"), (1, 3, "user", "bye"),
        (2, 0, "user", "alone"), (3, None, None, None), (3, 0, "assistant", "x"), (3, 0, "assistant", "x"), (None, 0, "user", "lost"),
    ], "conv_id long, turn int, role string, text string")
    got = {r["id"]: r for r in format_preferences(*echo_pairs(conversations(turns))).collect()}
    one = got[1]
    assert one["n_prompt_turns"] == 2 and one["prompt"].startswith("<|im_start|>system\nbe kind<|im_end|>\n") and "< |im_end|>" in one["prompt"]
    assert one["chosen"] == "<|im_start|>assistant\nhello<|im_end|>\n" and one["differs"]
    assert [one["chosen"][s["from"]:s["to"]] for s in one["chosen_mask"]] == ["hello<|im_end|>"]
    assert got[2]["chosen"] == got[2]["rejected"] == "" and not got[2]["differs"] and not got[2]["chosen_mask"]
    assert set(got) == {1, 2, 3} and got[3]["n_prompt_turns"] == 3  # the answer repeats the turn before it
    longer = conversations(turns.where("conv_id = 1")), conversations(turns.where("conv_id = 1 AND turn < 2"))
    row = format_preferences(*longer).first()
    assert row["n_prompt_turns"] == 2 and row["rejected"] == "" and row["chosen"].count("<|im_start|>") == 2
    assert format_preferences(*echo_pairs(conversations(turns.limit(0)))).count() == 0


@pytest.mark.parametrize("long_tail", [False, True])
def test_top_k_matches_brute_force(spark, monkeypatch, long_tail):
    from vigilseries.llm import topk
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "CHUNK", 8)
    rng = random.Random(2)
    size = [rng.paretovariate(0.7) if long_tail else 1.0 for _ in range(200)]
    rows = [(i, [rng.gauss(0, 1) * size[i] for _ in range(6)]) for i in range(200)]
    rows += [(300 + i, rows[i][1]) for i in range(5)] + [(400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (500, [1.0, 2.0]), (None, [1.0] * 6)]
    vectors = integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {}
    for r in top_k(vectors, vectors.where("id % 10 = 0"), 4).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    whole = {r["id"]: r["v"] for r in vectors.collect()}
    assert not set(whole) & {None, 400, 401, 402, 403}
    for q in (i for i in whole if i % 10 == 0):
        near = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:4]
        assert got.get(q, {}) == {k + 1: (i, -s) for k, (s, i) in enumerate(near)}
    assert top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_top_k_of_large_components(spark):
    def best(*vectors):
        v = integer_vectors(spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(vectors)], "vec_id long, embedding array<double>"))
        return [(r["vec_id"], r["score"]) for r in top_k(v, v.where("id = 0"), 2).orderBy("rank").collect()]
    assert best([2.0**20] * 4, [2.0**20] * 4, [2.0**20, 2.0**20, 2.0**20, 2.0**20 + 2.0**-10]) == [(2, 2**62 + 2**30), (1, 2**62)]
    assert best([2.0**-10, 0], [2.0**50, 0], [2.0**45, 2.0**45], [-(2.0**60), 0]) == [(1, 2**60), (2, 2**55)]
    assert best([2.0**30, 1], [-(2.0**60), 5], [0, 7], [0, 8]) == [(3, 1024 * 8192), (2, 1024 * 7168)]  # what does not fit is not among the best
    with pytest.raises(Exception, match="does not fit a long"):
        best([2.0**30] * 4, [2.0**30] * 4, [1.0] * 4)


def test_queries_of_all_operators_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert list(accumulate(len(v) for v in entry.oracle_sql().values()))[-1] > 0


@pytest.mark.parametrize("name", ["op2_near_duplicates", "op4_preferences", "op5_top_products", "op9_repeated_passages", "op12_target_sample"])
def test_sql_twins(spark, name):
    import duckdb

    from vigilseries.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    for t in ("conversations", "embeddings", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, "/root/testdata/sf0.001").toPandas(), con.execute(ORACLES[name]).df()
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns)
    a, b = (x[cols].sort_values(cols, ignore_index=True) for x in (ours, theirs))
    assert len(a) == len(b) and all(((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all() for c in cols)


def test_pipeline_runs_and_decides(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.store(stage(spark, docs, sf), "stage")
        assert after.columns == docs.columns and after.join(docs, "doc_id", "left_anti").count() == 0, name
        docs = after
        counts.append(after.count())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.count() == counts[-1] < counts[0] and out.where(F.size("ids") != F.col("n_pieces")).count() == 0


def odd_rows(spark):
    """Null and repeated ids, null and wordless texts, a benchmark passage under a null and under a shared id."""
    sf = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 200").first()["text"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fine = docs.where("doc_id = 1").first()["text"]
    rows = [(None, item), (5, item), (5, fine), (6, None), (7, ""), (7, fine), (None, None), (8, fine), (8, fine), (9, " \n ")]
    return spark.createDataFrame([(i, x, "en", None, len(x or "")) for i, x in rows], docs.schema), fine


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline
    docs, fine = odd_rows(spark)
    sf = "/root/testdata/sf0.001"

    def left(stage):
        return sorted(((r["doc_id"], r["text"]) for r in stage(spark, docs, sf).collect()), key=str)
    blank = [(6, None), (7, ""), (9, " \n "), (None, None)]
    assert left(corpus_pipeline.decontaminate) == sorted([*blank, (5, fine), (7, fine), (8, fine), (8, fine)], key=str)
    kept = left(corpus_pipeline.near)
    assert [x for x in kept if x in blank] == sorted(blank, key=str) and (7, fine) not in kept and (8, fine) not in kept and (5, fine) in kept
    assert corpus_pipeline.pieces(spark, docs, sf).count() == docs.count()
    assert corpus_pipeline.lines(spark, docs, sf).count() == docs.count()


def test_pipeline_on_empty_tables(spark):
    import corpus_pipeline
    docs = odd_rows(spark)[0].limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0, name


def test_pipeline_stages_bound_their_batches(spark, monkeypatch):
    """Stages may be run by themselves, in a session that was made elsewhere."""
    import corpus_pipeline
    asked = []
    monkeypatch.setattr(corpus_pipeline, "bound_batches", asked.append)
    docs = odd_rows(spark)[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "/root/testdata/sf0.001")
    assert asked == [spark] * len(corpus_pipeline.STAGES)


def test_dictionary_takes_one_python_step(spark, monkeypatch):
    """Two steps in a row would keep two workers per core in memory."""
    import public_tokenizers

    from vigilseries.llm import pieces as sp
    plans, write = {}, sp.store

    def store(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, label)
    monkeypatch.setattr(sp, "store", store)
    sp.encode(spark.createDataFrame([(1, "a few words"), (2, None)], "doc_id long, text string"), sp.load_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    assert plans["packed"].count("MapInArrow") == 1
