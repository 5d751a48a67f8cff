"""Connected components by alternating stars, over tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import stored
from shelfline.operators.lookups import join_folded


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return join_folded(both.where("b > a"), least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of these. Edges lead from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_folded(edges, least, ["a"], "inner").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Every round writes the edges that are left, so lineage stays short and no round depends on an executor's memory.
    A round that changes nothing ends the loop: every node then has one edge, to the smallest node.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = stored(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges = stored(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
