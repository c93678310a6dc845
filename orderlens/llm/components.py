"""Connected components by alternating large and small stars, each round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderlens.session import stored


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a table, and their number and checksum, counted while they are written."""
    seen = Observation()
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), checksum.alias("sum"))), tuple(seen.get.values())


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the undirected edges (a, b); the root is the component's least node.

    Each round links every node's larger neighbours, then its smaller ones, to the least of them, until the edges are
    stars. Minima combine on the map side and joins may be split, so a node with many neighbours needs no task of its own.
    """
    pair = (F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, state = _written(edges.select(*pair).filter("a <> b").distinct())
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges, new = _written(small.filter("a <> b").distinct())
        if new == state:
            break
        state = new
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
