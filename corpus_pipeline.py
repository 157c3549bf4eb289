"""From raw documents to encoded training text in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given. The
first four return the columns of ``documents``; the last returns the encoded
documents. Empty tables give empty tables. Null and wordless texts are never
drawn by the first stage; the other stages leave such rows as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilseries.llm.contamination import find_contamination
from vigilseries.llm.lines import dedup_lines
from vigilseries.llm.near import near_duplicates
from vigilseries.llm.pieces import encode, load_pieces
from vigilseries.llm.quality import importance_sample
from vigilseries.llm.regions import BROADCAST_IDS
from vigilseries.llm.scratch import store
from vigilseries.session import bound_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, gone: DataFrame, key: Column) -> DataFrame:
    """Rows of which ``key`` is not listed as ``key``; the list is broadcast only after counting it."""
    gone = store(gone.distinct(), "gone")
    listed = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(listed, key == listed["key"], "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the importance sample; toxic, junk and wordless documents go. Rows that repeat id and text are drawn alike."""
    return importance_sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of equal or similar lines; a document that loses all its lines stays with an empty text.

    Rows without an id keep all their lines; rows that repeat id and text count as one document.
    """
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates.

    Rows that share an id are one document and stay or go together. Rows without
    words or without an id stay.
    """
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("key"))
    return _without(docs, gone, F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("doc_id")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the rows that contain a benchmark item.

    Decided row by row: rows without an id go as well, and a clean row stays
    though another of its id goes. Equal rows go together.
    """
    row = F.xxhash64("doc_id", "text")
    named = docs.select(row.alias("key"), "text")
    found = find_contamination(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="key")
    return _without(docs, found.select("key"), row)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts: document columns without the text, ``ids`` and ``n_pieces``."""
    coded = encode(docs, load_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    return coded.withColumn("n_pieces", F.size("ids").cast("bigint")).drop("text")


def _bounded(stage: Stage) -> Stage:
    """The stage with bounded batches of its Python tasks, also where it is run by itself."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)
    return run


STAGES = [(name, _bounded(stage)) for name, stage in (
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", pieces),
)]

#: Hashes, draws and components of the stages cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages, each written once and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "docs")
    return STAGES[-1][1](spark, docs, sf_dir)
