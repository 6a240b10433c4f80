"""Operators on ``edges(src, dst)``: cleaning, node sets, degrees and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_edges(edges: DataFrame) -> DataFrame:
    """Each edge once. Copies are already merged before the shuffle, on both columns."""
    return edges.select("src", "dst").dropDuplicates(["src", "dst"])


def count_copies(edges: DataFrame) -> DataFrame:
    """A multigraph in compact form: each edge once, with the number of its copies."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))


def node_set(edges: DataFrame) -> DataFrame:
    """Distinct ids of either side; the edges are computed once."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def node_count(edges: DataFrame) -> DataFrame:
    return node_set(edges).agg(F.count(F.lit(1)).alias("nodes"))


def record_count(records: DataFrame) -> DataFrame:
    """Number of valid records of an adjacency source."""
    return records.agg(F.count(F.lit(1)).alias("records"))


def out_degrees(edges: DataFrame) -> DataFrame:
    """``(id, out_degree)`` of every node, 0 for pure targets; all in one shuffle."""
    starts = edges.select(F.col("src").alias("id"), F.lit(1).alias("links"))
    ends = edges.select(F.col("dst").alias("id"), F.lit(0).alias("links"))
    return starts.union(ends).groupBy("id").agg(F.sum("links").alias("out_degree"))


def dangling_nodes(edges: DataFrame) -> DataFrame:
    """Nodes without out-links."""
    return out_degrees(edges).where("out_degree = 0").select("id")


def linking_nodes(edges: DataFrame) -> DataFrame:
    """The complement: nodes with at least one out-link, and their degrees."""
    return out_degrees(edges).where("out_degree > 0")


def graph_stats(edges: DataFrame) -> DataFrame:
    """Nodes, edges and dangling nodes in one row."""
    return out_degrees(edges).agg(
        F.count(F.lit(1)).alias("nodes"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("edges"),
        F.count_if(F.col("out_degree") == 0).alias("dangling"),
    )


def initial_ranks(nodes: DataFrame, n: int | None = None) -> DataFrame:
    """``1/N`` for every row of ``nodes``.

    N is ``n`` where it is known; else the rows are counted by a scalar subquery, for which they are
    computed twice.
    """
    total = nodes.agg(F.count(F.lit(1))).scalar() if n is None else F.lit(n)
    return nodes.withColumn("rank", F.lit(1.0) / total)


def initial_dangling_mass(edges: DataFrame) -> DataFrame:
    """Rank that dangling nodes hold at the start: their share of all nodes."""
    return out_degrees(edges).agg(
        (F.count_if(F.col("out_degree") == 0) / F.count(F.lit(1))).alias("dangling_mass")
    )
