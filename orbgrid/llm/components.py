"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.llm.common import join_summary, stored


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (columns ``a``, ``b``) but the roots.

    The root is the smallest node of the component.  Edges are turned into
    stars by large-star and small-star rounds until nothing changes: about
    the logarithm of the longest path.  Minima are aggregated before they are
    joined back, so that a node with very many edges is never gathered; each round is stored.
    Null nodes and loops are ignored.
    """
    e = stored(spark, _down(edges.select("a", "b")).distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = join_summary(both, low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(spark, large.distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_summary(large, low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = stored(spark, small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        before, mark = mark, _mark(e)
        if before == mark:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _down(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges; equal when the round changed nothing."""
    h = F.xxhash64("a", "b").cast("decimal(20,0)")
    row = edges.agg(F.count("*"), F.sum(h), F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))).first()
    return tuple(row)
