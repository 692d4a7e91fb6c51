"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.tables import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a long, b long): component is the smallest node it reaches.

    Alternates the large-star and small-star steps; a node's neighbours are only joined with its minimum,
    never gathered, so a node with very many links is one skewed join key, which Spark splits. Each round is
    written to the shared folder. Self links and nulls are ignored; no edges give an empty table.
    """
    pairs = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct()
    state, before = saved(pairs, "links"), None
    while True:
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("x", "y"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        both = state.select(F.col("x").alias("u"), F.col("y").alias("v")).union(state.select("y", "x"))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").filter("v != m").select(F.col("v").alias("x"), F.col("m").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").filter("y != m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        state = saved(small.union(least.select("x", "m")).distinct(), "links")
    roots = state.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    return state.select(F.col("x").alias("node"), F.col("y").alias("component")).union(roots)
