"""Connected components by alternating stars, each round a few joins and sums over a written table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node, root (the smallest node of its component) for each node of the edges (u, v), both long.

    Every round links the larger neighbours of a node to its smallest one, then its smaller neighbours; the graph ends as
    stars. Minima are combined in the tasks before the shuffle, and a node with very many edges meets its minimum in a
    join whose hot side Spark splits. Self-loops and repeated edges do no harm; nodes without an edge are not in the result.
    """
    stars = landed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        stars = landed(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
