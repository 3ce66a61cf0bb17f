"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.store import saved


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of ``links`` (a, b: long), a self link included.

    Every round links each node to the smallest of its neighbours, first from above, then from below, until nothing changes; the
    number of rounds grows with the logarithm of the longest chain. Links stay as many as the nodes or fewer, and a round's
    result is written before the next one reads it.
    """
    edges = saved(links.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if now == state or not now[0]:
            break
        state = now
        # Large star: every larger neighbour of a node is linked to the smallest node around it.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        # Small star: a node's smaller neighbours and itself are linked to the smallest of them.
        down = large.select(F.col("v").alias("n"), F.col("u").alias("w"))
        lowest = down.groupBy("n").agg(F.min("w").alias("m"))
        small = down.join(lowest, "n").select(F.col("m").alias("u"), F.col("w").alias("v")).unionByName(
            lowest.select(F.col("m").alias("u"), F.col("n").alias("v")))
        edges = saved(small.where("u <> v").distinct(), "links")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    smallest = edges.groupBy("v").agg(F.min("u").alias("component"))
    return nodes.join(smallest, nodes["node"] == smallest["v"], "left").select(
        "node", F.coalesce("component", "node").alias("component"))
