"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilseries.llm.scratch import drop, store


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with a link to another node.

    ``component`` is the smallest node reachable. Links may repeat, point either
    way or loop. Each round hangs every node below the smallest neighbour; hubs
    only meet a minimum that was combined map-side, and the joins are plain
    equi-joins that adaptive execution may split. Rounds are written to the
    shared folder, so lost executors cost no more than one round.
    """
    pair = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    current = store(pair, "links")
    seen = None
    while True:
        stars = store(_small(_large(current)), "stars")
        drop(current)
        state = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("bigint"))).first()
        current = stars
        if state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state


def _large(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves below the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move below the smallest of them."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
