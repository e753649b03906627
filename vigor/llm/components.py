"""Connected components of an edge table, by alternating large-star and small-star steps over joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One step: every node's neighbours on one side hang below its smallest neighbour.  ``pairs`` is (u, v), u > v."""
    if large:
        around = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = pairs
    least = around.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
    hung = around.join(least, "u")
    if large:
        out = hung.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            least.select("u", F.col("low").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node it is connected with.

    ``edges`` are counted first (store them if they are costly).  Each round is stored; rounds grow with the logarithm of the longest path.  A node with very many neighbours is
    a key of joins and partial aggregates only, never a group in one task.
    """
    pairs = stored(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges", rows=edges.count())
    before, n = None, pairs.count()
    while True:
        pairs = stored(_star(_star(pairs, large=True), large=False), "stars", rows=n)
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, n = state, state[0]
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
