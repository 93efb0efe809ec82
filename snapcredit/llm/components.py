"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapcredit.llm.common import checkpointed


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Node and root, the smallest node of its component, for each node of `links` but the roots themselves.

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller ones; links
    never outnumber those of the start, rounds grow with the logarithm of the nodes. A round is cut with
    a checkpoint. Minima are aggregated before the shuffle, so a hub costs no more than its links.
    """
    u, v = F.col(a), F.col(b)
    edges = checkpointed(
        links.where(u != v).select(F.greatest(u, v).alias("node"), F.least(u, v).alias("root")).distinct()
    )
    while True:
        both = edges.select("node", "root").union(edges.select(F.col("root"), F.col("node"))).toDF("x", "y")
        least = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.where("x <> y").distinct()
        smallest = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(smallest, "x").select(
            F.explode(F.array(F.struct("x", "m"), F.struct(F.col("y").alias("x"), "m"))).alias("e")
        )
        after = checkpointed(
            small.select(F.col("e.x").alias("node"), F.col("e.m").alias("root")).where("node <> root").distinct()
        )
        # Done when every link already is a star: nothing moved, so each link stands in both tables.
        sides = after.select("*", F.lit(1).alias("new")).union(edges.select("*", F.lit(-1).alias("new")))
        moved = checkpointed(sides.groupBy("node", "root").agg(F.sum("new").alias("new")).where("new <> 0").limit(1))
        edges = after
        if moved.isEmpty():
            return edges
