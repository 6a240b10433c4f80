"""Sources that hold too many edges for one task.

Fewer than ``max_heavy`` sources can each hold more than one ``max_heavy``-th of all edges, however
large the graph is. A table with one row per such source therefore has a fixed size bound and is
safe to broadcast; every other source fits in a task. Splitting edges on that line keeps a hub from
ending up in a single task, and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

HEAVY_ROWS = 1_000_000
MAX_HEAVY = 10_000


def heavy_limit(n_edges: int, heavy_rows: int = HEAVY_ROWS, max_heavy: int = MAX_HEAVY) -> int:
    """Number of edges above which a source counts as heavy."""
    return max(heavy_rows, n_edges // max_heavy)


def heavy_sources(
    edges: DataFrame, heavy_rows: int = HEAVY_ROWS, max_heavy: int = MAX_HEAVY
) -> DataFrame | None:
    """The heavy sources as ``(src, edges)``, or None when there are none; the edges are read and counted once.

    There are fewer than ``max_heavy`` of them, so the largest ones are fetched by the job that counts all edges, and handed on as a
    small table instead of being counted again wherever they are used.
    """
    counts = edges.groupBy("src").agg(F.count(F.lit(1)).alias("edges"))
    seen = Observation()
    largest = counts.observe(seen, F.sum("edges").alias("total")).where(F.col("edges") > heavy_rows).orderBy(F.desc("edges")).limit(max_heavy).collect()
    limit = heavy_limit(seen.get.get("total") or 0, heavy_rows, max_heavy)
    rows = [r for r in largest if r["edges"] > limit]
    return edges.sparkSession.createDataFrame(rows, counts.schema) if rows else None


def split_by_source(
    edges: DataFrame, heavy: DataFrame | None
) -> tuple[DataFrame, DataFrame | None]:
    """Edges of ordinary sources and edges of heavy ones; the bounded side is broadcast."""
    if heavy is None:
        return edges, None
    keys = F.broadcast(heavy.select("src"))
    return edges.join(keys, "src", "left_anti"), edges.join(keys, "src", "left_semi")
