"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming join, exact check.

Words are lower-cased runs of letters and digits. A document's window has as many
words as an item and is compared by the word shingles of both; a document shorter
than the item is one window as a whole, if long enough to be similar. Only windows
that hold a shingle of some item can be similar, so only those are built. Each
gets a 64-bit SimHash, every occurrence of a shingle weighing one. A window meets
the items of its size under ``BLOCKS`` blocks of 8 bits: items are entered under
every value within ``RADIUS // BLOCKS`` bits of their own, so by the pigeonhole
principle every fingerprint within ``RADIUS`` bits is met. Shingle vectors at the
least similarity differ in 11 bits on average (standard deviation 3), so the
radius leaves out 3 in 100,000 of those and fewer of closer ones (of documents of
three or four shingles that lack one of the item, which differ in 12 bits on
average, about 3 in 10,000). What is met is confirmed exactly: the multiset Jaccard similarity of the shingles.

Everything is DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.scratch import store

SHINGLE = 5
PERCENT = 75
BLOCKS, RADIUS = 8, 23
LONG = 1 << 15
BROADCAST_ROWS = 1 << 21


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id, item, similarity, start, n_words)``: the best window of each document for each item it contains.

    A window has ``n_words`` words: as many as the item, or all of a shorter document.
    ``start`` counts words from 0; of equally similar windows the first is given.
    Null and wordless texts contain nothing and are contained nowhere; an item of
    fewer than five words is one shingle. Rows with a null id are looked at like
    others and give a null id; items without an id are left out. Rows that repeat
    a key are reported once.
    """
    given = items.select(F.col(item_col).alias("item"), _words(F.col(item_text_col)).alias("words")).where((F.size("words") > 0) & F.col("item").isNotNull())
    given = given.withColumn("k", F.least(F.size("words"), F.lit(SHINGLE)))
    sizes = sorted(r["k"] for r in given.select("k").distinct().collect())
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    parts = [_contained(texts, given.where(F.col("k") == k), k) for k in sizes]
    if not parts:
        kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
        parts = [docs.sparkSession.createDataFrame([], f"id {kinds[0]}, item {kinds[1]}, similarity double, start int, n_words int")]
    best = reduce(DataFrame.unionByName, parts).groupBy("id", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("later"), "n_words")).alias("at"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("at.similarity").alias("similarity"),
                       (-F.col("at.later")).alias("start"), F.col("at.n_words").alias("n_words"))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: str, k: int) -> Column:
    """Hashes of all runs of ``k`` words."""
    picked = ", ".join(f"h[i + {j}]" for j in range(k))
    made = f"transform(array(transform({words}, w -> xxhash64(w))), h -> transform(sequence(0, size(h) - {k}), i -> xxhash64({picked})))[0]"
    return F.expr(f"CASE WHEN size({words}) >= {k} THEN {made} ELSE CAST(array() AS ARRAY<BIGINT>) END")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast after counting; a longer table is joined by key."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _contained(texts: DataFrame, given: DataFrame, k: int) -> DataFrame:
    span = (F.size("words") - k + 1).alias("span")
    entries = store(given.select("item", span, _shingles("words", k).alias("grams")), "items")
    anchors = store(entries.select("span", F.explode("grams").alias("gram")).groupBy("gram").agg(F.collect_set("span").alias("spans")), "anchors")

    # Where documents hold a shingle of an item.
    grams = texts.select("id", "key", _words(F.col("text")).alias("words")).select("id", "key", _shingles("words", k).alias("grams"))
    placed = grams.select("id", "key", F.size("grams").alias("n"), F.posexplode("grams").alias("pos", "gram"))
    hits = store(placed.join(_small(anchors), "gram").select("id", "key", "n", "pos", "spans"), "hits")
    ids = store(hits.select("id", "key").distinct(), "ids")
    held = store(_null_safe_semi(texts, _small(ids)).select("id", "key", _words(F.col("text")).alias("words"))
                 .select("id", "key", _shingles("words", k).alias("grams")).dropDuplicates(["id", "key"]), "held")

    # Windows around them, and their fingerprints.
    starts = _starts(hits.select("id", "key", "n", "pos", F.explode("spans").alias("span")))
    windows = _null_safe(starts, held).select("id", "key", "span", "start", F.slice("grams", F.col("start") + 1, F.col("span")).alias("grams"))
    windows = windows.select("id", "key", "span", "start", F.explode("grams").alias("gram"))
    width = 16 if (entries.agg(F.max("span")).first()[0] or 0) < LONG else 32
    marked = _fingerprint(windows, ["id", "key", "span", "start"], width)
    coded = store(_fingerprint(entries.select("item", "span", F.explode("grams").alias("gram")), ["item", "span"], width)
                  .withColumnRenamed("mark", "item_mark"), "marks")
    near = [v for v in range(256) if v.bit_count() <= RADIUS // BLOCKS]
    entered = coded.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))) \
        .withColumn("value", F.explode(F.transform(F.array(*map(F.lit, near)), lambda v: v.bitwiseXOR(_block(F.col("item_mark"), F.col("block"))))))
    entered = store(entered, "entered")
    seen = marked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))).withColumn("value", _block(F.col("mark"), F.col("block")))
    met = seen.join(_small(entered), ["span", "block", "value"])
    apart = F.col("mark").bitwiseXOR(F.col("item_mark"))
    first = reduce(lambda a, b: a & b, [(F.col("block") <= b) | (F.bit_count(_block(apart, F.lit(b))) > RADIUS // BLOCKS) for b in range(BLOCKS - 1)])
    met = met.where((F.bit_count(apart) <= RADIUS) & first).select("id", "key", "span", "start", "item")

    # Exact similarity of the shingle multisets.
    exact = _null_safe(met, held).withColumn("a", F.slice("grams", F.col("start") + 1, F.col("span"))).drop("grams")
    exact = exact.join(_small(entries.select("item", F.col("grams").alias("b"))), "item")
    both = F.expr("""aggregate(array_intersect(a, b), 0, (s, g) -> s + least(size(filter(a, x -> x = g)), size(filter(b, x -> x = g))))""")
    exact = exact.withColumn("both", both).withColumn("either", F.size("a") + F.col("span") - F.col("both")).where(100 * F.col("both") >= PERCENT * F.col("either"))
    similarity = F.col("both") / F.col("either")
    return exact.select("id", "item", similarity.alias("similarity"), "start", (F.size("a") + k - 1).alias("n_words"))


def _starts(hits: DataFrame) -> DataFrame:
    """Every start of a window of ``span`` shingles that covers a hit and fits in its document; 0 in a shorter document.

    With ``n`` shingles of ``span`` the similarity is ``n / span`` at most.
    """
    low = F.greatest(F.col("pos") - F.col("span") + 1, F.lit(0))
    high = F.greatest(F.least(F.col("pos"), F.col("n") - F.col("span")), F.lit(0))
    fits = hits.where(100 * F.col("n").cast("bigint") >= PERCENT * F.col("span"))
    return fits.select("id", "key", "span", F.explode(F.sequence(low, high)).alias("start")).distinct()


def _null_safe(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.withColumnsRenamed({"id": "_id", "key": "_key"})
    return left.join(other, (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))).drop("_id", "_key")


def _null_safe_semi(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.select(F.col("id").alias("_id"), F.col("key").alias("_key"))
    return left.join(other, (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id")), "left_semi")


def _block(mark: Column, block: Column) -> Column:
    """Eight bits of a fingerprint."""
    return F.call_function("shiftrightunsigned", mark, (block * 8).cast("int")).bitwiseAND(F.lit(255)).cast("int")


def _fingerprint(grams: DataFrame, keys: list[str], width: int) -> DataFrame:
    """SimHash of each group: bit b is set where most shingles (with repeats) have it.

    Counters of ``width`` bits share a sum: 16 sums count all 64 bits of groups of
    fewer than ``LONG`` shingles, 32 sums (``width`` 32) those of longer ones.
    """
    mask = sum(1 << at for at in range(0, 64, width))
    lanes = [F.sum(F.call_function("shiftrightunsigned", F.col("gram"), F.lit(j)).bitwiseAND(F.lit(mask))).alias(f"s{j}") for j in range(width)]
    counted = grams.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *lanes)
    bits = []
    for j in range(width):
        for at in range(0, 64, width):
            ones = F.call_function("shiftrightunsigned", F.col(f"s{j}"), F.lit(at)).bitwiseAND(F.lit((1 << width) - 1))
            bit = 1 << (j + at)
            bits.append(F.when(2 * ones > F.col("n"), F.lit(bit - (1 << 64) if bit >> 63 else bit)).otherwise(F.lit(0).cast("bigint")))
    return counted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("mark"))
