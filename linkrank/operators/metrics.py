"""Validation metrics of ranks and of changes between two sets of ranks; their sums do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkrank.functions import steady_sum

STOP_RULES = ("max", "l1")


def rank_total(ranks: DataFrame) -> DataFrame:
    """Total rank and its distance from 1."""
    return ranks.agg(steady_sum(F.col("rank")).alias("total_rank")).withColumn(
        "error", F.abs(F.col("total_rank") - 1.0)
    )


def dangling_sum() -> Column:
    return steady_sum(F.when(F.col("out_degree") == 0, F.col("rank")))


def dangling_mass(state: DataFrame) -> DataFrame:
    """Rank held by nodes without out-links."""
    return state.agg(F.coalesce(dangling_sum(), F.lit(0.0)).alias("dangling_mass"))


def _changes() -> list[Column]:
    """Largest, average and total of ``delta``; rows without one don't count."""
    total = steady_sum(F.col("delta"))
    average = F.when(F.count("delta") > 0, total / F.count("delta"))
    return [F.max("delta").alias("max_delta"), average.alias("avg_delta"), total.alias("l1_delta")]


def rank_delta(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Both ranks and their distance for every node of either side; a missing rank is 0."""
    now = current.select("id", F.col("rank").alias("rank"))
    before = previous.select("id", F.col("rank").alias("previous_rank"))
    joined = now.join(before, "id", "full_outer").select(
        "id",
        F.coalesce("rank", F.lit(0.0)).alias("rank"),
        F.coalesce("previous_rank", F.lit(0.0)).alias("previous_rank"),
    )
    return joined.withColumn("delta", F.abs(F.col("rank") - F.col("previous_rank")))


def delta_summary(deltas: DataFrame) -> DataFrame:
    """Largest, average and total change, and the number of nodes, in one row (0 when empty)."""
    return deltas.agg(*_changes(), F.count(F.lit(1)).alias("nodes")).na.fill(0.0)


def compare(current: DataFrame, previous: DataFrame) -> DataFrame:
    return delta_summary(rank_delta(current, previous))


def iteration_metrics(
    current: DataFrame, previous: DataFrame | None = None, tol: float = 1e-6, rule: str = "max"
) -> DataFrame:
    """Check one stored iteration, ``(id, out_degree, rank)``, in one row.

    Gives total rank and its error, the dangling mass, and largest, average and total change against
    ``previous``; without that the changes are NULL and ``converged``, by ``rule``, is false.
    """
    below = _below(tol, rule)
    if previous is None:
        joined = current.select("id", "out_degree", "rank").withColumn(
            "delta", F.lit(None).cast("double")
        )
    else:
        before = previous.select("id", F.col("rank").alias("previous_rank"))
        joined = current.join(before, "id", "full_outer").select(
            "id",
            "out_degree",
            "rank",
            F.expr("abs(coalesce(rank, 0D) - coalesce(previous_rank, 0D))").alias("delta"),
        )
    return joined.agg(
        F.count("rank").alias("nodes"),
        F.coalesce(steady_sum(F.col("rank")), F.lit(0.0)).alias("total_rank"),
        F.coalesce(dangling_sum(), F.lit(0.0)).alias("dangling_mass"),
        *_changes(),
    ).select(
        "nodes",
        "total_rank",
        F.abs(F.col("total_rank") - 1.0).alias("error"),
        "dangling_mass",
        "max_delta",
        "avg_delta",
        "l1_delta",
        below.alias("converged"),
    )


def _below(tol: float, rule: str) -> Column:
    """Whether the rule's statistic exists and lies strictly below ``tol``."""
    if tol <= 0:
        raise ValueError(f"tol must be greater than zero, not {tol}")
    if rule not in STOP_RULES:
        raise ValueError(f"rule must be one of {STOP_RULES}, not {rule!r}")
    return F.coalesce(F.col(f"{rule}_delta") < tol, F.lit(False))


def history_of_snapshots(snapshots: DataFrame, tol: float = 1e-6, rule: str = "max", by: str = "id") -> DataFrame:
    """Metrics of every iteration from stored ``(iteration, id, out_degree, rank)``, judged by ``rule``.

    The previous rank of a node comes from a window over its own few rows; a node that appears later
    starts from 0. ``by`` names the column that tells the nodes apart: with ``key`` a history in buckets isn't moved.
    """
    below = _below(tol, rule)
    own = Window.partitionBy(by).orderBy("iteration")
    first = snapshots.agg(F.min("iteration")).scalar()
    before = F.coalesce(F.lag("rank").over(own), F.lit(0.0))
    changes = snapshots.withColumn(
        "delta", F.when(F.col("iteration") > first, F.abs(F.col("rank") - before))
    )
    return (
        changes.groupBy("iteration")
        .agg(
            steady_sum(F.col("rank")).alias("total_rank"),
            F.coalesce(dangling_sum(), F.lit(0.0)).alias("dangling_mass"),
            *_changes(),
        )
        .withColumn("converged", below)
    )


def has_converged(max_delta: float | None, l1_delta: float | None, tol: float, rule: str) -> bool:
    """Whether the rule's statistic exists and lies strictly below ``tol``."""
    if rule not in STOP_RULES:
        raise ValueError(f"rule must be one of {STOP_RULES}, not {rule!r}")
    statistic = max_delta if rule == "max" else l1_delta
    return statistic is not None and statistic < tol
