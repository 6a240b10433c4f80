"""The ranking loop.

One Spark job per iteration: links and state are read from tables bucketed by node, joined without an
exchange, contributions are summed before and after the only shuffle, and the new state is
written to its buckets. The metrics of the iteration are observed while it is written, and are all that
reaches the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkrank.functions.sums import high_part, low_part, steady_sum, total_of, unit_for
from linkrank.operators.adjacency import validate_unique
from linkrank.operators.metrics import STOP_RULES, dangling_sum, has_converged
from linkrank.operators.step import (
    UNKNOWN_TARGETS,
    check_step_arguments,
    rank_step,
)
from linkrank.plans.graph import Graph, bounded_hash, reopen_graph
from linkrank.plans.journal import Journal
from linkrank.plans.workspace import Workspace, shuffle_partitions

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("iteration", T.IntegerType(), False),
        T.StructField("total_rank", T.DoubleType(), False),
        T.StructField("dangling_mass", T.DoubleType(), False),
        T.StructField("max_delta", T.DoubleType()),
        T.StructField("avg_delta", T.DoubleType()),
        T.StructField("l1_delta", T.DoubleType()),
        T.StructField("converged", T.BooleanType(), False),
        T.StructField("seconds", T.DoubleType(), False),
    ]
)


@dataclass(frozen=True)
class RankResult:
    """Outcome of a run; tables stay in the workspace of the graph until that is closed."""

    graph: Graph
    state: DataFrame
    history_rows: list[tuple]
    converged: bool
    damping: float
    tol: float | None
    snapshot_tables: dict[int, str] = field(default_factory=dict)
    #: The N of the formulas, and the seconds outside the iterations.
    n: int = 0
    preparation_seconds: float = 0.0
    #: Number of the run in the journal of a named workspace, else 0.
    run: int = 0

    @property
    def iterations(self) -> int:
        """Number of the last iteration; those of the runs that this one goes on from count."""
        return self.history_rows[-1][0]

    @property
    def seconds(self) -> float:
        """Preparation and all iterations."""
        return self.preparation_seconds + sum(row[-1] for row in self.history_rows)

    @property
    def ranks(self) -> DataFrame:
        """``(id, rank)`` after the last iteration, converged or not."""
        return _with_ids(self.graph, self.state).select("id", "rank")

    @property
    def ranked_nodes(self) -> DataFrame:
        """``(id, out_degree, rank)`` after the last iteration."""
        return _with_ids(self.graph, self.state)

    @property
    def history(self) -> DataFrame:
        """One row of metrics per iteration."""
        return self.graph.spark.createDataFrame(self.history_rows, HISTORY_SCHEMA)

    def snapshot(self, iteration: int) -> DataFrame:
        """``(id, out_degree, rank)`` after the given iteration, if history was kept."""
        return _with_ids(self.graph, self._snapshot_state(iteration))

    def keyed_snapshot(self, iteration: int) -> DataFrame:
        """``(key, id, out_degree, rank)`` after a kept iteration, in the buckets of the graph."""
        return _with_ids(self.graph, self._snapshot_state(iteration), "key")

    def keyed_ranks(self) -> DataFrame:
        """``(key, id, out_degree, rank)`` after the last iteration, in the buckets of the graph."""
        return _with_ids(self.graph, self.state, "key")

    def snapshots(self) -> DataFrame:
        """``(iteration, id, out_degree, rank)`` of all kept iterations, each joined in its buckets."""
        kept = [
            self.snapshot(i).select(F.lit(i).alias("iteration"), "id", "out_degree", "rank")
            for i in self.snapshot_tables
        ]
        return reduce(DataFrame.union, kept)

    def delta(self, iteration: int, previous: int) -> DataFrame:
        """``(id, rank, previous_rank, delta)`` of two kept iterations, which meet by key in their buckets; a missing rank is 0."""
        return joined_by_key(self.graph, self._snapshot_state(iteration), self._snapshot_state(previous))

    def _snapshot_state(self, iteration: int) -> DataFrame:
        if iteration not in self.snapshot_tables:
            raise KeyError(f"iteration {iteration} was not kept")
        return self.graph.workspace.table(self.snapshot_tables[iteration])

    def close(self) -> None:
        self.graph.workspace.close()


def rank(
    graph: Graph,
    damping: float = 0.85,
    tol: float | None = 1e-6,
    max_iter: int = 20,
    rule: str = "max",
    first_iteration_can_converge: bool = False,
    unknown_targets: str = "drop",
    initial_ranks: DataFrame | None = None,
    keep_history: bool = False,
    n: int | None = None,
    first_iteration: int = 1,
    history: DataFrame | None = None,
) -> RankResult:
    """Rank the nodes of ``graph`` until the change falls below ``tol``, at most ``max_iter`` times.

    ``rule`` looks at the largest change of a node (``"max"``) or at the sum of changes (``"l1"``); with
    ``tol=None`` all iterations are run. By default the first iteration of all has nothing to be compared with.

    ``initial_ranks(id, rank)`` goes on from an earlier run, whose last iteration every step is compared with. The
    outcome is that of one run, if the earlier run's own N is given as ``n`` (the nodes of the graph otherwise),
    ``first_iteration`` is the number that comes next, and ``history`` has the rows so far. In a named workspace every
    iteration is recorded, and ``resume`` goes on from there.
    """
    n = graph.n if n is None else n
    check_step_arguments(n, 0.0, damping)
    if first_iteration < 1:
        raise ValueError(f"first_iteration must be greater than zero, not {first_iteration}")
    if isinstance(max_iter, bool) or not isinstance(max_iter, int) or max_iter <= 0:
        raise ValueError(f"max_iter must be a positive whole number, not {max_iter!r}")
    if tol is not None and tol <= 0:
        raise ValueError(f"tol must be greater than zero, not {tol}")
    if rule not in STOP_RULES:
        raise ValueError(f"rule must be one of {STOP_RULES}, not {rule!r}")
    if unknown_targets not in UNKNOWN_TARGETS:
        raise ValueError(f"unknown_targets must be one of {UNKNOWN_TARGETS}, not {unknown_targets!r}")

    began = time.perf_counter()
    rows = [tuple(r) for r in history.orderBy("iteration").collect()] if history is not None else []
    options = {"damping": damping, "tol": tol, "max_iter": len(rows) + max_iter, "rule": rule, "first_iteration_can_converge": first_iteration_can_converge, "unknown_targets": unknown_targets, "keep_history": keep_history}
    table = None
    if initial_ranks is not None:
        table = graph.workspace.new_name("start")
        with shuffle_partitions(graph.spark, graph.partitions):
            graph.workspace.save(_state_from(graph, initial_ranks), table, "id", graph.partitions)
    begin = {"graph": graph.describe(), "state": table, "rows": rows, "tables": {}, "options": options, "n": n, "next": first_iteration, "compared": table is not None, "converged": False}
    run = Journal(graph.workspace).begin(begin) if graph.workspace.kept else 0
    return _run(graph, begin, run, time.perf_counter() - began)


def resume(spark: SparkSession, name: str, max_iter: int | None = None, folder: str | None = None, run: int | None = None) -> RankResult:
    """Go on with the newest run in the named workspace ``name`` from its last finished iteration, or from its beginning if there is none.

    The newest run is the one that began last, however far earlier ones got; ``run`` names another one (``runs`` lists them). All options
    are those of the run, and so is the number of iterations in all unless ``max_iter`` is given. A run that had ended is returned as it is.
    """
    workspace = Workspace.reopen(spark, name, folder)
    journal = Journal(workspace)
    found = journal.newest() if run is None else journal.last(run)
    if found is None:
        raise ValueError(f"no finished iteration and no run begun in {workspace.location}" + (f" under number {run}" if run else ""))
    noted = found.values
    graph = reopen_graph(workspace, noted["graph"])
    noted["tables"] = {int(k): v for k, v in noted["tables"].items()}
    for table in {noted["state"], *noted["tables"].values()} - {None}:
        workspace.attach(table, "id", graph.partitions)
    if max_iter is not None:
        noted["options"]["max_iter"] = max_iter
    return _run(graph, noted, found.run, 0.0)


def runs(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """``(run, iterations, last_iteration, converged, nodes, damping, threshold)`` of all runs begun in the named workspace ``name``."""
    return Journal(Workspace.reopen(spark, name, folder)).table()


def _run(graph: Graph, noted: dict, run: int, seconds: float) -> RankResult:
    """Iterate from what was noted last: a state by key, the rows and tables so far, and the options."""
    workspace, options, n = graph.workspace, noted["options"], noted["n"]
    tol, rule = options["tol"], options["rule"]
    rows, tables = [tuple(r) for r in noted["rows"]], dict(noted["tables"])
    converged, last_table = noted["converged"], noted["state"]
    name = f"run{time.time_ns()}"
    with shuffle_partitions(graph.spark, graph.partitions):
        began = time.perf_counter()
        if last_table is not None:
            state = workspace.table(last_table)
            held, everything = state.agg(dangling_sum(), steady_sum(F.col("rank"))).first()
            dangling, before = held or 0.0, everything or 0.0
        else:
            state = graph.start_state() if n == graph.n else graph.start_state().withColumn("rank", F.lit(1.0 / n))
            dangling, before = graph.n_dangling / n, graph.n / n
        # Members of the graph for each one that N counts; targets that become nodes are more.
        members = max(1.0, (graph.n if options["unknown_targets"] == "drop" else graph.nodes.count()) / n)
        before_loop = graph.seconds + seconds + time.perf_counter() - began

        for iteration in range(noted["next"], noted["next"] + options["max_iter"] - len(rows)):
            if converged:
                break
            started = time.perf_counter()
            table = f"{name}_{iteration}"
            observed = Observation()
            # No more rank than this can there be after the step, and no more of it can change.
            unit = unit_for(before + members * (1.0 + before))
            stepped = rank_step(
                graph.links, state, n, dangling, options["damping"], options["unknown_targets"], before
            ).observe(observed, *_metrics(unit))
            state = workspace.save(stepped.drop("previous_rank"), table, "id", graph.partitions)
            seen = observed.get

            change, before = (total_of(seen[f"{x}_high"], seen[f"{x}_low"], unit) for x in ("l1", "total"))
            compared = noted["compared"] or options["first_iteration_can_converge"]
            largest, average, total = (seen["max_delta"], change / seen["rows"], change) if compared else (None, None, None)
            converged = tol is not None and has_converged(largest, total, tol, rule)
            dangling = total_of(seen["dangling_high"], seen["dangling_low"], unit)
            rows.append(
                (
                    iteration,
                    before,
                    dangling,
                    largest,
                    average,
                    total,
                    converged,
                    time.perf_counter() - started,
                )
            )
            tables = tables | {iteration: table} if options["keep_history"] else {iteration: table}
            noted = noted | {"state": table, "rows": rows, "tables": tables, "next": iteration + 1, "compared": True, "converged": converged}
            if run:
                Journal(workspace).note(run, iteration, noted)
            if not options["keep_history"] and last_table:
                workspace.drop(last_table)
            last_table = table

    return RankResult(graph, state, rows, converged, options["damping"], tol, tables, n, before_loop, run)


def _metrics(unit: float) -> list[Column]:
    """Metrics of one iteration; sums come as two whole numbers each, so that the order of additions doesn't show."""
    rank, held = F.col("rank"), F.when(F.col("out_degree") == 0, F.col("rank"))
    change = F.abs(F.col("rank") - F.col("previous_rank"))
    sums = {"total": rank, "dangling": held, "l1": change}
    parts = [F.sum(part(x, unit)).alias(f"{name}_{of}") for name, x in sums.items() for of, part in (("high", high_part), ("low", low_part))]
    return [*parts, F.max(change).alias("max_delta"), F.count(F.lit(1)).alias("rows")]


def _state_from(graph: Graph, initial_ranks: DataFrame) -> DataFrame:
    """State by key from ``(id, rank)``; nodes without a given rank start at 0."""
    validate_unique(initial_ranks)
    stranger = initial_ranks.join(graph.nodes.select("id"), "id", "left_anti").first()
    if stranger is not None:
        raise ValueError(f"initial rank for {stranger['id']!r}, which is not in the graph")
    given = initial_ranks.select(graph.key(F.col("id")).alias("given_key"), "rank")
    nodes = graph.nodes.where("member").select("key", "out_degree")
    return nodes.join(given, F.col("key") == F.col("given_key"), "full_outer").select(
        F.coalesce("key", "given_key").alias("id"),
        F.coalesce("out_degree", F.lit(0).cast("long")).alias("out_degree"),
        F.coalesce("rank", F.lit(0.0)).alias("rank"),
    )


def _with_ids(graph: Graph, state: DataFrame, *more: str) -> DataFrame:
    """Put ids back in place of keys; both tables have the same buckets, of bounded size. ``key`` can be kept."""
    names = graph.nodes.select("key", F.col("id").alias("name"))
    return state.join(bounded_hash(names, graph.partitions), F.col("id") == F.col("key")).select(
        *more, F.col("name").alias("id"), "out_degree", "rank"
    )


def joined_by_key(graph: Graph, state: DataFrame, other: DataFrame, *more: str) -> DataFrame:
    """``(id, rank, previous_rank, delta)`` of two states of one graph, which meet its nodes in their buckets. ``key`` can be kept."""
    zero = F.lit(0.0)
    now = bounded_hash(state.select(F.col("id").alias("now"), "rank"), graph.partitions)
    before = bounded_hash(other.select(F.col("id").alias("before"), F.col("rank").alias("previous_rank")), graph.partitions)
    both = graph.nodes.select("key", "id").join(now, F.col("key") == F.col("now"), "left").join(before, F.col("key") == F.col("before"), "left")
    both = both.where("now IS NOT NULL OR before IS NOT NULL")
    both = both.select(*more, "id", F.coalesce("rank", zero).alias("rank"), F.coalesce("previous_rank", zero).alias("previous_rank"))
    return both.withColumn("delta", F.abs(F.col("rank") - F.col("previous_rank")))
