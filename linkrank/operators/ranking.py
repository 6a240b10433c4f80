"""Orderings: by rank, by id, and the newest of several snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.functions import integer_order, is_integer
from linkrank.plans.workspace import Workspace


#: Rows that one task may sort and that may be broadcast.
FEW = 10_000


def by_rank() -> list[Column]:
    """Highest rank first, equal ranks by id."""
    return [F.desc("rank"), F.asc("id")]


def top_k(ranks: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` highest ranks; each task keeps only its own best ``k``."""
    return ranks.select("id", "rank").orderBy(*by_rank()).limit(k)


def top_k_positions(ranks: DataFrame, k: int = 20, workspace: Workspace | None = None) -> DataFrame:
    """The same with positions from 1, for any ``k``.

    Up to ``FEW`` rows are sorted in one task; a longer list is numbered by ranges, each in a task of its own, so it may
    have all nodes. For that, ``workspace`` holds the ordered rows.
    """
    if k <= FEW:
        position = F.row_number().over(Window.orderBy(*by_rank()))
        return top_k(ranks, k).select(position.cast("long").alias("position"), "id", "rank")
    space = workspace or Workspace(ranks.sparkSession)
    return number_rows(ranks.select("id", "rank"), by_rank(), space, space.new_name("ordered")).where(F.col("position") <= k)


def ranking_full(ranks: DataFrame) -> DataFrame:
    """All nodes in order of rank (a range partitioned sort)."""
    return ranks.select("id", "rank").orderBy(*by_rank())


def node_order_columns(nodes: DataFrame) -> list[Column]:
    """Sort columns for ids: by value if all are whole numbers, else by text."""
    all_integers = nodes.agg(F.bool_and(is_integer(F.col("id")))).scalar()
    return [F.when(all_integers, integer_order(F.col("id"))), F.col("id")]


def order_nodes(nodes: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """By id, and by part where nodes have several rows: those of a node are then neighbours, across files too.

    Rows are dealt by ranges of both, so that no task holds a node with many parts. ``order`` are the columns of
    ``node_order_columns``, if they are known.
    """
    order = node_order_columns(nodes) if order is None else order
    return nodes.orderBy(*order, *(["part"] if "part" in nodes.columns else []))


def number_rows(df: DataFrame, order: list[Column], workspace: Workspace, name: str, stage: bool = True) -> DataFrame:
    """Add a global ``position`` from 1 in the given order, without sorting in one task.

    ``df`` is read twice, once to find the ranges; so it is written first, and computed once. ``stage=False`` leaves that out
    for rows that are stored already.

    Rows move once, to ranges of the order, are sorted there and written with the number of their range and
    their place in it. Counts per range give the offsets. ``order`` should be unique, so that no range can
    hold more than its share.
    """
    columns = df.columns
    if stage:
        df = workspace.save(df, f"{name}_rows")
    # Spark's row number: the partition in the upper bits, the place within it in the lower 33.
    numbered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", F.monotonically_increasing_id())
    local = F.col("number").bitwiseAND(F.lit(2**33 - 1))
    stored = workspace.save(numbered.select(*columns, F.shiftright("number", 33).alias("slice"), local.alias("local")), name)
    if stage:
        workspace.drop(f"{name}_rows")

    counts = stored.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice: as many as there are shuffle partitions, whatever the data.
    offset = F.coalesce(F.sum("rows").over(before), F.lit(0))
    offsets = counts.select("slice", offset.alias("offset"))
    return stored.join(F.broadcast(offsets), "slice").select((F.col("offset") + F.col("local") + 1).alias("position"), *columns)


def latest_snapshot(history: DataFrame) -> DataFrame:
    """Rows of the highest iteration in ``history(iteration, ...)``.

    The number comes from a scalar subquery, so partitions of other iterations are not read.
    """
    last = history.agg(F.max("iteration")).scalar()
    return history.where(F.col("iteration") == last)
