"""Connected components of a table of links, by alternating large and small stars.

Every round is a written table, so lineage stays short and a lost executor costs a round at
most. Hubs are no single row: minima are aggregated before the shuffle, and the joins that
spread them are plain equi-joins, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node with a link to another; component: its smallest node.

    Null ends and links of a node to itself count for nothing; repeated links for one.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = written(edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
