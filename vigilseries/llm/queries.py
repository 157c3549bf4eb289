"""One query per operator over the whole of its table, and the SQL twins of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilseries.llm.chat import conversations, echo_pairs, format_preferences
from vigilseries.llm.contamination import find_contamination
from vigilseries.llm.language import identify_languages
from vigilseries.llm.lines import dedup_lines
from vigilseries.llm.near import near_duplicates
from vigilseries.llm.pieces import SPACE, decode, encode, load_pieces
from vigilseries.llm.quality import importance_sample
from vigilseries.llm.resample import resample
from vigilseries.llm.shards import assign_shards
from vigilseries.llm.spans import remove_repeats
from vigilseries.llm.tokens import count_tokens
from vigilseries.llm.topk import integer_vectors, top_k
from vigilseries.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"), Path(public_tokenizers.path("byte_bpe_50k.json")).read_text())


@query
def op2_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


ORACLES["op2_near_duplicates"] = """
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
b AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS n FROM g p JOIN g q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT b.a, b.b FROM b JOIN n u ON u.doc_id = b.a JOIN n v ON v.doc_id = b.b WHERE 100 * b.n >= 75 * (u.n + v.n - b.n)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.least AS component_id, doc_id = c.least AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a) c USING (doc_id)
"""


@query
def op9_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    out = remove_repeats(table(spark, sf, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op9_repeated_passages"] = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (SELECT r, doc_id, i, array_to_string(w[i:i + 19], ' ') AS x FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
o AS (SELECT r, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS place FROM s),
g AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS p, true AS gone FROM o WHERE place > 1),
e AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
k AS (SELECT r, count(gone) AS n, string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone IS NULL) AS kept FROM e LEFT JOIN g USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(k.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""


@query
def op6_quality_sample(spark: SparkSession, sf: str) -> DataFrame:
    drawn = importance_sample(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return drawn.select("doc_id", "log_weight", "noisy_weight")


@query
def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    return identify_languages(table(spark, sf, "documents"))


@query
def op8_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    out = dedup_lines(table(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query
def op3_contamination(spark: SparkSession, sf: str) -> DataFrame:
    return find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op4_preferences(spark: SparkSession, sf: str) -> DataFrame:
    told = conversations(table(spark, sf, "conversations"))
    made = format_preferences(*echo_pairs(told))
    spans = {m: F.array_join(F.transform(m, lambda s: F.concat_ws("-", s["from"].cast("string"), s["to"].cast("string"))), ",").alias(m)
             for m in ("chosen_mask", "rejected_mask")}
    return made.select(F.col("id").alias("conv_id"), "n_prompt_turns", "prompt", "chosen", "rejected", *spans.values(), "differs")


ORACLES["op4_preferences"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
e AS (
  SELECT conv_id, count(*) AS n, coalesce(max(CASE WHEN role = 'assistant' THEN i END), 0) AS last FROM t GROUP BY conv_id),
x AS (
  SELECT e.*, coalesce(a.text, '') AS answer, coalesce(b.text, '') AS echo
  FROM e LEFT JOIN t a ON a.conv_id = e.conv_id AND a.i = e.last LEFT JOIN t b ON b.conv_id = e.conv_id AND b.i = e.last - 1),
p AS (
  SELECT *, CASE WHEN last = 0 THEN n WHEN answer = echo THEN last ELSE last - 1 END AS k FROM x),
s AS (
  SELECT t.conv_id, string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY i) AS prompt
  FROM t JOIN p ON p.conv_id = t.conv_id WHERE i <= k GROUP BY t.conv_id)
SELECT p.conv_id, k AS n_prompt_turns, coalesce(prompt, '') AS prompt,
       CASE WHEN k < last THEN '<|im_start|>assistant' || chr(10) || replace(answer, '<|', '< |') || '<|im_end|>' || chr(10) ELSE '' END AS chosen,
       CASE WHEN k < last THEN '<|im_start|>assistant' || chr(10) || replace(echo, '<|', '< |') || '<|im_end|>' || chr(10) ELSE '' END AS rejected,
       CASE WHEN k < last THEN '22-' || (22 + length(replace(answer, '<|', '< |')) + 10) ELSE '' END AS chosen_mask,
       CASE WHEN k < last THEN '22-' || (22 + length(replace(echo, '<|', '< |')) + 10) ELSE '' END AS rejected_mask,
       k < last AS differs
FROM p LEFT JOIN s ON s.conv_id = p.conv_id
"""


@query
def op5_top_products(spark: SparkSession, sf: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf, "embeddings"))
    return top_k(vectors, vectors.where("id % 100 = 0"))


ORACLES["op5_top_products"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""


@query
def op7_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    pieces = load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    coded = encode(table(spark, sf, "documents").select("doc_id", "text"), pieces)
    out = decode(coded, pieces)
    same = F.col("decoded").eqNullSafe(F.coalesce(F.replace("text", F.lit(SPACE), F.lit(" ")), F.lit("")))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", same.alias("round_trip"))


@query
def op11_shards(spark: SparkSession, sf: str) -> DataFrame:
    return assign_shards(table(spark, sf, "documents"))


@query
def op12_target_sample(spark: SparkSession, sf: str) -> DataFrame:
    return resample(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("key")


# CRC-32 by its table; the table of eight shifts a byte is folded from 0 to 255.
ORACLES["op12_target_sample"] = """
WITH crc AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY b) AS t FROM range(256) r(b)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w, row_number() OVER () AS r FROM documents),
q AS (
  SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
f AS (
  SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS x FROM d WHERE len(w) > 0),
g AS (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS x FROM q WHERE len(w) > 0),
u AS (SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM f UNION SELECT x FROM g)),
b AS MATERIALIZED (
  SELECT x, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
                            lambda c, v: xor(c >> 8, t[1 + (xor(c, v) & 255)])), 4294967295) % 10000 AS k FROM u, crc),
s AS (SELECT k, count(*) AS n FROM f JOIN b USING (x) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM g JOIN b USING (x) GROUP BY k),
gain AS (
  SELECT k, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (SELECT coalesce(sum(n), 0) + 10000 FROM s)::DOUBLE
                            / ((coalesce(s.n, 0)::DOUBLE + 1) * (SELECT coalesce(sum(n), 0) + 10000 FROM t)::DOUBLE)))::BIGINT AS v
  FROM s FULL JOIN t USING (k)),
m AS (SELECT r, count(*) AS n, floor(sum(v) / count(*))::BIGINT AS weight FROM f JOIN b USING (x) JOIN gain USING (k) GROUP BY r),
e AS (
  SELECT doc_id, coalesce(len(w), 0) AS words, coalesce(m.n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
  FROM d LEFT JOIN m USING (r)),
o AS (
  SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY words >= 20 ORDER BY weight + noise DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY words >= 20) AS able FROM e)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN words >= 20 AND place <= able * 25 // 100 THEN place END AS BIGINT) AS rank FROM o
"""


@query
def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(table(spark, sf, "embeddings"))
