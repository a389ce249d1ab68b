"""Connected components of a large edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflux.llm.common import StageTables


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edge list (a, b); root is the smallest node that it reaches.

    Nodes are longs. Each round hangs a node's larger neighbours on the least of its
    neighbourhood, then its smaller ones, until the edges are stars around the roots;
    the number of rounds grows with the logarithm of a component's size. Rounds are
    written tables, of which only the last stays. The least neighbours are written before they are joined, so that
    the join is between plain tables and a hub's edges can be split over tasks.
    """
    flat = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    kept = StageTables()
    stars = kept.write(flat, "stars")
    before = _state(stars)
    while before[0]:
        with StageTables() as tables:
            both = stars.select(F.col("u").alias("x"), F.col("v").alias("y")).union(stars.select(F.col("v"), F.col("u")))
            least = tables.write(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m")), "least")
            large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
            large = tables.write(large, "large")
            least = tables.write(large.groupBy("u").agg(F.min("v").alias("m")), "least")
            hung = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            following = StageTables()
            stars = following.write(least.select("u", F.col("m").alias("v")).union(hung).distinct(), "stars")
        kept.remove()
        kept = following
        after = _state(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
