"""Connected components of a graph given as edges between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import Work


def connected_components(edges: DataFrame, work: Work, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every end of an edge; component is the smallest reachable node.

    Edges come as ``(a, b)``; loops, repeats and rows with a null are ignored, and nodes only in those are not returned.
    Alternates the large-star and the small-star step until the edges stay as they are; the number of rounds grows with the
    logarithm of the longest path. Every step is an aggregation that combines before its exchange, and a
    join of two written tables, whose hot keys adaptive execution splits. Only a count and a checksum reach the driver.
    """
    ends = edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    now = work.store(ends.distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("lo", "hi")).alias("x")).first()
        if mark == before or not mark["n"]:
            break
        before = mark
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(now.select("hi", "lo"))
        low = work.store(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = work.store(large.distinct(), "large")
        low = work.store(large.groupBy("hi").agg(F.min("lo").alias("m")), "low")
        small = large.join(low, "hi").where("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        now = work.store(small.union(low.select("m", "hi")).distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(now.select("lo", "lo").distinct())
