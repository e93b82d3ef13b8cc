"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from novalake.llm.common import staged


def _least(edges: DataFrame) -> DataFrame:
    """``u`` with ``m``, the least of it and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = both.join(_least(both), "u").filter(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    moved = down.join(_least(down), "u")
    moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(moved.select("u", F.col("m").alias("v")))
    return moved.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``u``, ``v``): the least node of its component.

    Each round is written to the shared folder. Hot nodes are aggregated before the shuffle, and the
    joins are plain ones that adaptive execution can split.
    """
    edges = staged(links.select("u", "v").filter("u != v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = staged(_small_star(_large_star(edges)), "links")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
