"""Connected components of a graph of 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node.

    Alternating stars: every node links its larger neighbours, then its smaller ones, to the
    smallest node it knows. The number of edges does not grow, stars of any size are aggregated
    before they are shuffled, and the number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    pairs, seen = checkpointed(pairs.distinct()), None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        lowest = lowest.select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpointed(small.unionByName(lowest.toDF("u", "v")).distinct())
        state = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == seen:
            break
        seen = state
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
