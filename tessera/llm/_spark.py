"""Shared Spark helpers: lineage cuts in shared storage, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.shared import cut, drop_table, folder, shared_dir, table

__all__ = ["components", "cut", "drop_table", "folder", "shared_dir", "table"]


def _stars(e: DataFrame) -> bool:
    """Whether every node hangs from one other, and those hang from none."""
    if e.groupBy("hi").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        tops = e.select(F.col("lo").alias("top")).distinct()
        return tops.join(e, F.col("top") == F.col("hi"), "left_semi").isEmpty()
    return False


def _large(e: DataFrame) -> DataFrame:
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("mu"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("mu")).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("mu"), "m")
    moved = e.join(least, F.col("hi") == F.col("mu")).select("lo", "m").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select(F.col("mu").alias("hi"), F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (hi, lo), component being the smallest node that can be reached.

    Alternating large-star and small-star rounds; every round moves only minima and single links, never a whole
    neighbourhood, and ends in shared storage. The rounds grow with the logarithm of the longest chain.
    """
    e = cut(edges.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).filter("hi <> lo").distinct())
    while not _stars(e):
        e = cut(_small(_large(e)))
    own = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return own.unionByName(e.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component")))
