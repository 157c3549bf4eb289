"""Near-duplicates, lines, repeated passages and contamination."""

import random

import pytest
import regex
from llm.brute import components, line_sets, multiset_similarity, shingles, without_repeats
from pyspark.sql import functions as F

from vigilseries.llm import spans
from vigilseries.llm.components import components as linked
from vigilseries.llm.contamination import find_contamination
from vigilseries.llm.lines import dedup_lines
from vigilseries.llm.near import near_duplicates
from vigilseries.llm.spans import remove_repeats


def edited(rng, base, edits):
    w = base.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def copies():
    """A star of near copies around an original, exact copies, and unrelated texts."""
    rng = random.Random(3)
    base = " ".join(f"w{rng.randrange(500)}" for _ in range(150))
    rows = [(i, edited(rng, base, rng.randrange(7))) for i in range(120)]
    rows += [(200 + i, base) for i in range(20)]
    return rows + [(300 + i, " ".join(f"v{rng.randrange(500)}" for _ in range(rng.choice([1, 4, 5, 60])))) for i in range(30)]


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (7, 8), (8, 8), (1, 1), (4, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in linked(links).collect()}
    assert {k: v for k, v in got.items() if k != v} == {4: 3, 5: 3, 9: 3, 8: 7}


def test_near_duplicates_match_brute_force(spark, copies):
    got = {r["doc_id"]: r for r in near_duplicates(spark.createDataFrame(copies, "doc_id long, text string")).collect()}
    sets = [(i, shingles(x)) for i, x in copies]
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets}
    assert {i: r["component_id"] for i, r in got.items()} == components(sets)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_shingles"] == 0 and by_id[0]["kept"] and by_id[1]["component_id"] == 1
    assert by_id[50]["component_id"] == 8 and not by_id[50]["kept"]
    assert by_id[4]["component_id"] == 3  # id 3 repeats with the text of 4
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeats_match_brute_force(spark, corpus, monkeypatch, hot):
    monkeypatch.setattr(spans, "HOT", hot)
    rows = [(r["doc_id"], r["text"]) for r in corpus.where("doc_id < 60").select("doc_id", "text").collect()]
    rows += [(1000, "der " * 90), (1001, "x " + "der " * 25 + "y"), (1002, " ".join(map(str, range(20)))), (1003, " ".join(map(str, range(19)))),
             (1004, "a " + " ".join(map(str, range(25)))), (1005, None), (1006, "")]
    # Repeated ids: equal places do not cover each other, an earlier start of the other row does.
    same, tail = " ".join(f"s{k}" for k in range(25)), " ".join(f"t{k}" for k in range(40))
    rows += [(2000, f"{same} one {tail}"), (2000, f"{same} two"), (2000, f"{same} one {tail}"), (2000, f"x y z {tail} {same}"), (2001, same),
             (2002, f"more {tail} {same}"), (2002, f"{tail} {same}")]
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("h", F.sha2("kept", 256))
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["h"]) for r in out.collect()) == without_repeats(rows)


def test_repeats_odd_rows(odd_docs, no_docs):
    rows = remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["kept"] == "" and by_id[None]["n_removed"] == 0 and by_id[50]["n_removed"] == by_id[50]["n_words"] > 0
    assert remove_repeats(no_docs).count() == 0


def test_lines_match_brute_force(spark, corpus):
    rng = random.Random(5)
    rows = [(r["doc_id"], r["text"]) for r in corpus.where("doc_id < 40").select("doc_id", "text").collect()]
    line = " ".join(f"phrase{rng.randrange(99)}" for _ in range(40))
    rows += [(500 + i, f"own line {i} of this one document\n{edited(rng, line, i % 3)}\n\n  {line}  ") for i in range(20)]
    got = {r["doc_id"]: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    places = {}
    for i, x in sorted(rows):
        for k, raw in enumerate(x.split("\n")):
            if raw.strip(" \t\r"):
                places.setdefault(raw.strip(" \t\r"), []).append((i, k))
    order = sorted(places, key=lambda x: places[x][0])
    group = components([(places[x][0], line_sets(x)) for x in order])
    for i, x in rows:
        keep = [raw for k, raw in enumerate(x.split("\n")) if not raw.strip(" \t\r") or group[places[raw.strip(" \t\r")][0]] == (i, k)]
        assert got[i]["text"] == "\n".join(keep), i


def test_lines_odd_rows(odd_docs, no_docs):
    out = dedup_lines(odd_docs)
    assert out.columns == [*odd_docs.columns, "n_lines", "n_dropped"] and out.count() == odd_docs.count()
    rows = out.where("doc_id IS NULL OR doc_id IN (1, 50)").collect()
    assert {r["doc_id"]: (r["text"], r["n_dropped"]) for r in rows if r["doc_id"]} == {1: (None, 0), 50: ("", 1)}
    assert next(r for r in rows if r["doc_id"] is None)["n_dropped"] == 0
    assert dedup_lines(no_docs).count() == 0
    own = ["_id", "_key", "_gone", "line", "no", "n_lines", "__id"]
    kept = dedup_lines(odd_docs.withColumns({c: F.lit(f"own {c}") for c in own}))
    assert kept.count() == odd_docs.count() and kept.select([c for c in own if c != "n_lines"]).distinct().collect() == [tuple(f"own {c}" for c in own if c != "n_lines")]
    assert dict(kept.dtypes)["n_lines"] == "bigint"


def test_contamination_matches_brute_force(spark):
    rng = random.Random(9)
    items = [(i, " ".join(f"q{rng.randrange(300)}" for _ in range(rng.randint(3, 50)))) for i in range(25)] + [(90, None), (91, "")]
    docs = []
    for i in range(60):
        own = [f"d{rng.randrange(300)}" for _ in range(rng.randrange(80))]
        leak = edited(rng, items[i % 25][1], rng.randrange(3)).upper() + ("!" if i % 2 else "")
        at = rng.randrange(len(own) + 1)
        docs.append((i, " ".join([*own[:at], *([leak] if i % 3 else []), *own[at:]])))
    out = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in out.collect()}
    want = {}
    for d, x in docs:
        w = regex.findall(r"[\p{L}\p{N}]+", x.lower())
        for i, y in items:
            v = regex.findall(r"[\p{L}\p{N}]+", (y or "").lower())
            k = min(5, len(v))
            for s in range(len(w) - len(v) + 1 if v else 0):
                a, b = ([tuple(z[t:t + k]) for t in range(len(z) - k + 1)] for z in (w[s:s + len(v)], v))
                j = multiset_similarity(a, b)
                if j >= 0.75 and j > want.get((d, i), (0, 0))[0]:
                    want[d, i] = (j, s)
    assert len(want) > 15 and got == want


def test_contamination_of_documents_shorter_than_the_item(spark):
    rng = random.Random(10)
    items = [(i, [f"q{rng.randrange(300)}" for _ in range(n)]) for i, n in enumerate((8, 20, 40, 60))]
    docs = [(1000, items[2][1][:-1]), (1001, items[2][1][:20] + items[2][1][21:]), (1002, items[2][1][:30])]
    for _, v in items:
        for _ in range(30):
            w = list(v)
            for _ in range(rng.randint(1, 1 + len(w) // 3)):
                del w[rng.choice([0, -1, rng.randrange(len(w))])]
            docs.append((len(docs), w))
    want = {}
    for d, w in docs:
        for i, v in items:
            a, b = ([tuple(z[t:t + 5]) for t in range(len(z) - 4)] for z in (w, v))
            if len(w) < len(v) and a and (j := multiset_similarity(a, b)) >= 0.75:
                want[d, i] = (j, 0, len(w))
    told = [spark.createDataFrame([(i, " ".join(w)) for i, w in x], f"{name} long, text string") for x, name in ((docs, "doc_id"), (items, "item_id"))]
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"], r["n_words"]) for r in find_contamination(*told).collect()}
    assert want[1000, 2][0] == 35 / 36 and want[1001, 2][0] == 31 / 40 and (1002, 2) not in want and len(want) > 20 and got == want


def test_fingerprint_of_a_very_long_item(spark, monkeypatch):
    from vigilseries.llm import contamination
    widths, made = [], contamination._fingerprint
    monkeypatch.setattr(contamination, "_fingerprint", lambda grams, keys, *width: widths.append(made(grams, keys, *width)) or widths[-1])
    long = spark.createDataFrame([(1, " ".join(["same"] * 70_000))], "item_id long, text string")
    find_contamination(spark.createDataFrame([], "doc_id long, text string"), long)
    gram = spark.sql("SELECT xxhash64(h, h, h, h, h) FROM (SELECT xxhash64('same') AS h)").first()[0]
    assert [r["mark"] for r in widths[1].collect()] == [gram]


def test_contamination_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "word"), (2, None), (7, "same text here again and again"), (None, "word"), (1, "word")], "item_id long, text string")
    got = sorted({(r["doc_id"], r["item_id"]) for r in find_contamination(odd_docs, items).collect()}, key=str)
    assert got == sorted({(5, 1), (8, 7), (50, 7)}, key=str)
    assert find_contamination(no_docs, items).count() == 0 and find_contamination(odd_docs, items.limit(0)).count() == 0


def test_pairs_known_to_differ_are_not_compared_again(spark):
    """Regions of two sets that were neighbours hold no news; larger ones are compared whole."""
    import numpy as np

    from vigilseries.llm.regions import across
    regions = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 20), (5, 20)], "id long, region long")
    sets = spark.createDataFrame([(i, bytearray(np.arange(8, dtype=np.uint64).tobytes())) for i in (1, 2, 3, 5)] + [(4, bytearray(np.arange(90, 98, dtype=np.uint64).tobytes()))], "id long, shingles binary")
    grouped = spark.createDataFrame([], "node long, component long")

    def links(*least):
        return sorted((r["a"], r["b"]) for r in across(regions, sets, grouped, 75, least=least[0] if least else 2).collect())
    assert links() == [(1, 2), (3, 5)] and links(3) == [(3, 5)]
