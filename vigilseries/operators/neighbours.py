"""Exact nearest-neighbour join, similarity search and neighbour votes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilseries.functions.scalars import NORMAL, round4, truncate_doc
from vigilseries.operators.index import BLOCK_ROWS, COPIES, NeighbourIndex, build_index

__all__ = ["NeighbourIndex", "analyze_embedded", "analyze_logs", "build_index", "knn_anomaly_prob", "knn_classify", "knn_join",
           "neighbour_votes", "similar_logs"]
MOST_SIMILAR = 10


def knn_join(queries: DataFrame, corpus: DataFrame | NeighbourIndex, k: int, vec_col: str, id_col: str, metric: str = "cosine",
             payload: Sequence[str] = (), exclude_self: bool = False, block: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest corpus rows of every query: (qid, rank, cid, distance, payload...).

    Exact; ties go to the smaller id. A frame is indexed for this one search, an
    index is used as it is (its own metric holds, and it must hold the payload).
    Rows without a vector have no neighbours and are none.
    """
    if isinstance(corpus, NeighbourIndex):
        if lacking := set(payload) - set(corpus.payload):
            raise ValueError(f"the index does not hold {sorted(lacking)}")
        found = corpus.search(queries, vec_col, id_col, k, exclude_self)
        return found.select("qid", "rank", "cid", "distance", *payload)
    index = build_index(corpus, vec_col, id_col, metric=metric, payload=payload, copies=k + 1 if exclude_self else k, block=block)
    return index.search(queries, vec_col, id_col, k, exclude_self)


def similar_logs(queries: DataFrame, corpus: DataFrame | NeighbourIndex, vec_col: str = "embedding", id_col: str = "id", k: int = 5,
                 payload: Sequence[str] = (), approx: bool = False, recall: float = 0.9, stats: dict | None = None) -> DataFrame:
    """Top-k by cosine with ``similarity`` rounded to 4 places.

    With ``approx`` candidates come from hashed buckets, looked into until a
    sample of queries reaches ``recall`` (see ``NeighbourIndex.search_approx``);
    their similarities are exact.
    """
    if approx:
        index = corpus if isinstance(corpus, NeighbourIndex) else build_index(corpus, vec_col, id_col, payload=payload, copies=max(k, COPIES))
        found = index.search_approx(queries, vec_col, id_col, k, recall, stats=stats)
    else:
        found = knn_join(queries, corpus, k, vec_col, id_col, payload=payload)
    return found.select("qid", "rank", "cid", round4(1 - F.col("distance")).alias("similarity"), *payload)


def neighbour_votes(queries: DataFrame, corpus: DataFrame | NeighbourIndex, vec_col: str, label_col: str, id_col: str, k: int = 7) -> DataFrame:
    """Votes of the k nearest per query and label: (qid, label, votes, share)."""
    found = knn_join(queries, corpus, k, vec_col, id_col, payload=[label_col])
    votes = found.groupBy("qid", F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("votes"))
    return votes.withColumn("share", F.col("votes") / F.sum("votes").over(Window.partitionBy("qid")))


def _winner(votes: DataFrame) -> DataFrame:
    """Most votes; a tie goes to the smallest label."""
    top = F.min(F.struct((-F.col("votes")).alias("minus"), F.col("label"), F.col("share")))
    return votes.groupBy("qid").agg(
        top.alias("w"),
        (F.lit(1.0) - F.coalesce(F.sum(F.when(F.col("label").cast("string") == NORMAL, F.col("share"))), F.lit(0.0))).alias("p_anomaly"),
    ).select("qid", F.col("w.label").alias("label"), F.col("w.share").alias("confidence"), "p_anomaly")


def knn_classify(queries: DataFrame, corpus: DataFrame | NeighbourIndex, vec_col: str, label_col: str, id_col: str, k: int = 7) -> DataFrame:
    """(qid, label, confidence) by uniform vote of the k nearest by cosine."""
    return _winner(neighbour_votes(queries, corpus, vec_col, label_col, id_col, k)).drop("p_anomaly")


def knn_anomaly_prob(queries: DataFrame, corpus: DataFrame | NeighbourIndex, vec_col: str, label_col: str, id_col: str, k: int = 7) -> DataFrame:
    """(qid, label, confidence, p_anomaly): p_anomaly is the vote share that is not ``normal``."""
    return _winner(neighbour_votes(queries, corpus, vec_col, label_col, id_col, k))


def analyze_embedded(queries: DataFrame, train: DataFrame | NeighbourIndex, store: DataFrame | NeighbourIndex, vec_col: str = "embedding",
                     label_col: str = "category", id_col: str = "id", document_col: str = "document",
                     metadata_col: str | None = "metadata", k: int = 7, top_k: int | str = 3) -> DataFrame:
    """One row per query id: category, confidence and the ``similar_logs`` array; all null for a line without a vector.

    Votes come from the train split, similar logs from the whole store; either
    may be a stored index. ``top_k`` is a number for all lines or the name of a
    column with each line's own, from 1 to 10 (3 where it is null).
    """
    own = isinstance(top_k, str)
    every = queries.select(F.col(id_col).alias("qid"), *([F.coalesce(F.col(top_k), F.lit(3)).alias("_top")] if own else [])).distinct()
    if own:
        fits = F.col("_top").between(1, MOST_SIMILAR)
        every = every.withColumn("_top", F.when(fits, F.col("_top")).otherwise(F.raise_error(F.lit(f"top_k must be 1 to {MOST_SIMILAR}")).cast("int")))
    classes = knn_anomaly_prob(queries, train, vec_col, label_col, id_col, k)
    payload = [document_col, *([metadata_col] if metadata_col else [])]
    near = similar_logs(queries, store, vec_col, id_col, MOST_SIMILAR if own else top_k, payload)
    entry = F.struct("rank", truncate_doc(F.col(document_col)).alias("document"),
                     *([F.col(metadata_col).alias("metadata")] if metadata_col else []), "similarity")
    listed = near.groupBy("qid").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e.dropFields("rank")).alias("similar_logs"))
    logs = F.slice("similar_logs", F.lit(1), F.col("_top")) if own else F.col("similar_logs")
    return every.join(classes, "qid", "left").join(listed, "qid", "left").select(
        F.col("qid").alias(id_col), F.col("label").alias("predicted_category"), round4(F.col("confidence")).alias("confidence"),
        "p_anomaly", logs.alias("similar_logs"))


def analyze_logs(logs: DataFrame, train: DataFrame | NeighbourIndex, store: DataFrame | NeighbourIndex, encode: Callable[[DataFrame], DataFrame],
                 id_col: str = "id", **options) -> DataFrame:
    """``analyze_embedded`` for log lines as text: ``encode`` adds the column ``embedding``, as the stored vectors were made.

    Every line gets a row; a line that ``encode`` gives no vector has nulls.
    """
    return analyze_embedded(encode(logs), train, store, id_col=id_col, **options)
