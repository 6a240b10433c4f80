"""Reports of a run: top list, convergence table, summary and ledger.

All of them are small by nature: ``k`` rows, one row per iteration, or one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.functions import fixed, scientific, yes_no
from linkrank.operators.ranking import FEW, by_rank, number_rows, top_k, top_k_positions
from linkrank.plans.graph import bounded_hash
from linkrank.plans.iterate import RankResult, joined_by_key

# Column headings of the reports. Those of the convergence table are fixed values; ``Node`` and ``Rank`` are
# neutral names. Pass others where a reader expects them.
TOP_COLUMNS = ("Node", "Rank")
CONVERGENCE_COLUMNS = (
    "Iteration",
    "TotalRank",
    "DanglingMass",
    "MaxDelta",
    "AverageDelta",
    "Converged",
)
TIME_COLUMNS = ("Iteration", "Seconds")


def top_report(ranks: DataFrame, k: int = 20, columns: Sequence[str] = TOP_COLUMNS) -> DataFrame:
    """The ``k`` highest ranks in order, with 15 decimals."""
    return top_k(ranks, k).orderBy(*by_rank()).select("id", fixed(F.col("rank"))).toDF(*columns)


def convergence_report(
    history: DataFrame, columns: Sequence[str] = CONVERGENCE_COLUMNS
) -> DataFrame:
    """Metrics of every iteration; ``inf`` where there was nothing to compare with."""
    return (
        history.orderBy("iteration")
        .select(
            "iteration",
            fixed(F.col("total_rank")),
            fixed(F.col("dangling_mass")),
            scientific(F.col("max_delta")),
            scientific(F.col("avg_delta")),
            yes_no(F.col("converged")),
        )
        .toDF(*columns)
    )


def times_report(history: DataFrame, columns: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """Whole seconds of every iteration."""
    return (
        history.orderBy("iteration")
        .select("iteration", F.round("seconds").cast("long"))
        .toDF(*columns)
    )


def write_csv(report: DataFrame, path: str, mode: str = "errorifexists", files: int | None = 1) -> None:
    """CSV with a header, in the order of the report; one file, or ``files=None`` for one from each task."""
    (report if files is None else report.coalesce(files)).write.mode(mode).option("header", True).csv(path)


def run_summary(result: RankResult, dataset: str, implementation: str = "spark") -> DataFrame:
    """One row about a run; ``seconds`` has preparation and iterations, ``preparation_seconds`` the former alone."""
    row = (implementation, dataset, result.n, result.damping, result.tol, result.iterations, result.converged)
    return result.graph.spark.createDataFrame(
        [(*row, result.history_rows[-1][1], float(result.seconds), float(result.preparation_seconds))],
        "implementation string, dataset string, nodes long, damping double, threshold double, "
        "iterations long, converged boolean, total_rank double, seconds double, preparation_seconds double",
    )


def write_summary(summary: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The summary as ``name=value`` lines."""
    pairs = F.array(
        *[
            F.concat_ws("=", F.lit(name), F.coalesce(F.col(name).cast("string"), F.lit("")))
            for name in summary.columns
        ]
    )
    summary.select(F.explode(pairs).alias("value")).coalesce(1).write.mode(mode).text(path)


def ledger_row(summary: DataFrame) -> DataFrame:
    return summary.select(
        F.col("implementation").alias("engine"),
        "dataset",
        F.col("nodes").alias("num_nodes"),
        "iterations",
        "seconds",
    )


def append_ledger(summary: DataFrame, path: str) -> None:
    """Add the run to the ledger of all runs."""
    ledger_row(summary).coalesce(1).write.mode("append").parquet(path)


def write_ledger_csv(ledger: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All runs of a ledger as one CSV file with one header."""
    write_csv(ledger.orderBy("engine", "dataset", "iterations"), path, mode)


def compare_runs(result: RankResult, other: RankResult, k: int = 20) -> DataFrame:
    """``(id, rank, previous_rank, delta, place, other_place)`` of two runs on one prepared graph.

    A node that one of them lacks has rank 0 there. The places are those among the first ``k``, 0 beyond. States
    meet by key in their buckets. Up to ``FEW`` places are broadcast; more are
    numbered by ranges and stored in the same buckets as the states, so ``k`` may be the number of nodes.
    """
    graph = result.graph
    if graph.workspace is not other.graph.workspace or graph.partitions != other.graph.partitions or graph.key is not other.graph.key:
        raise ValueError("the runs must share one prepared graph; see Graph.without_copies")
    both = joined_by_key(graph, result.state, other.state, "key")
    if k <= FEW:
        first, second = (top_k_positions(run.ranks, k).select("id", F.col("position").alias(name)) for run, name in ((result, "place"), (other, "other_place")))
        placed = both.join(F.broadcast(first.join(second, "id", "full_outer")), "id", "left")
    else:
        placed = both
        for run, name in ((result, "place"), (other, "other_place")):
            placed = placed.join(bounded_hash(_places(run, k, name), graph.partitions), "key", "left")
    none = F.lit(0).cast("long")
    return placed.select(
        "id", "rank", "previous_rank", "delta",
        F.coalesce("place", none).alias("place"), F.coalesce("other_place", none).alias("other_place"),
    )


def _places(run: RankResult, k: int, name: str) -> DataFrame:
    """``(key, <name>)`` of the first ``k`` nodes, in the buckets of the graph."""
    space, buckets = run.graph.workspace, run.graph.partitions
    ordered = space.new_name("ordered")
    numbered = number_rows(run.keyed_ranks().select("key", "id", "rank"), by_rank(), space, ordered)
    places = numbered.where(F.col("position") <= k).select("key", F.col("position").alias(name)).repartition(buckets, "key")
    stored = space.save(places, space.new_name("places"), "key", buckets)
    space.drop(ordered)
    return stored
