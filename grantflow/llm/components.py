"""Connected components of a large link table by alternating stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.session import cut, cut_table


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them. Links run from larger to smaller."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``: the smallest node of its component.

    Nodes are any orderable values; links of a node with itself and links with null do not count. Ends when a round
    changes nothing; a component of ``n`` nodes takes about ``log n`` rounds, however long its paths.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = cut_table(links)
    mark = None
    while state.rows:
        state = cut_table(_small_star(_large_star(state.df)))
        now = state.df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    pairs = state.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return cut(pairs.unionByName(pairs.select(F.col("root").alias("node"), "root")).distinct())
