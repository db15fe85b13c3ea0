"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.storage import stored


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``links`` (``a``, ``b``: long).

    Each round hangs every node's larger neighbours, then its smaller ones,
    on its smallest neighbour; the number of rounds grows with the logarithm
    of the longest path. Links with a null end or between equal nodes are
    ignored, repeated ones count once. Rounds are written to the shared
    folder; the joins on a node that very many links share are of the kind
    that adaptive execution splits. The driver sees two sums a round.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)))
        # hash sums as decimals: no overflow
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("m")).withColumn("m", F.least("node", "m"))
    moved = both.where("other > node").join(least, "node")
    return moved.select(F.col("other").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
