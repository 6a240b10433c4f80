"""The registered queries: one per operator, each ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank import Workspace, adjacency_to_ranked as to_ranked, check_ranked_files, edges_to_adjacency, prepare, prepare_records, rank, resume, runs, write_ranked
from linkrank.operators import adjacency, edges, metrics, ranking, step
from linkrank.plans.history import open_history, store_history
from linkrank.plans.iterate import RankResult
from linkrank.sinks import (
    adjacency_lines,
    append_ledger,
    compare_runs as compare,
    convergence_report,
    run_summary,
    top_report,
    write_csv,
    write_history,
    write_ledger_csv,
    write_lines,
)
from linkrank.sources import (
    parse_adjacency,
    parse_edges,
    parse_ranked,
    parse_records,
    ranked_nodes_of,
    read_parts,
    read_ranked,
    reject_counts as counts_by_reason,
)
from queries import graphs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    """Register a query under its name; a closing underscore only keeps it apart from an operator."""
    REGISTRY[query.__name__.rstrip("_")] = query
    return query


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


def rounded(column: str) -> Column:
    """Ten decimals, so that the order of additions does not show."""
    return F.round(F.col(column), 10).alias(column)


def joined(column: str = "neighbors") -> Column:
    return F.array_join(column, ",").alias(column)


# Sources


@register
def parse_edges_whitespace(spark: SparkSession, folder: str) -> DataFrame:
    return parse_edges(graphs.item_lines(spark, folder, graphs.EDGE_LINE))[0]


@register
def parse_edges_whitespace_at_least(spark: SparkSession, folder: str) -> DataFrame:
    lines = graphs.item_lines(spark, folder, graphs.EDGE_LINE)
    return parse_edges(lines, fields="at_least")[0]


@register
def parse_edges_tab(spark: SparkSession, folder: str) -> DataFrame:
    lines = graphs.item_lines(spark, folder, graphs.EDGE_LINE)
    return parse_edges(lines, sep="tab", fields="at_least", comment=None)[0]


@register
def rejected_edges(spark: SparkSession, folder: str) -> DataFrame:
    return parse_edges(graphs.item_lines(spark, folder, graphs.EDGE_LINE))[1]


@register
def parse_adjacency_(spark: SparkSession, folder: str) -> DataFrame:
    records = parse_adjacency(graphs.item_lines(spark, folder, graphs.RECORD_LINE))[0]
    return records.select("id", joined())


@register
def parse_ranked_nodes(spark: SparkSession, folder: str) -> DataFrame:
    records = parse_ranked(graphs.item_lines(spark, folder, graphs.RECORD_LINE))[0]
    return records.select("id", rounded("rank"), joined())


@register
def rejected_records(spark: SparkSession, folder: str) -> DataFrame:
    return parse_records(graphs.item_lines(spark, folder, graphs.RECORD_LINE))[1]


@register
def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts_by_reason(parse_records(graphs.item_lines(spark, folder, graphs.RECORD_LINE))[1])


# Graph preparation


@register
def dedupe_edges(spark: SparkSession, folder: str) -> DataFrame:
    return edges.dedupe_edges(graphs.page_links(spark, folder))


@register
def count_copies(spark: SparkSession, folder: str) -> DataFrame:
    return edges.count_copies(graphs.nation_trade(spark, folder))


@register
def node_set(spark: SparkSession, folder: str) -> DataFrame:
    return edges.node_set(graphs.page_links(spark, folder))


@register
def node_count(spark: SparkSession, folder: str) -> DataFrame:
    return edges.node_count(graphs.trade(spark, folder))


@register
def adjacency_record_count(spark: SparkSession, folder: str) -> DataFrame:
    lines = graphs.item_lines(spark, folder, graphs.RECORD_LINE)
    return edges.record_count(parse_records(lines)[0])


@register
def adjacency_lists(spark: SparkSession, folder: str) -> DataFrame:
    lists = adjacency.adjacency_lists(graphs.part_supp(spark, folder))
    return lists.select("id", "part", joined())


@register
def adjacency_multilists(spark: SparkSession, folder: str) -> DataFrame:
    lists = adjacency.adjacency_lists(graphs.part_supp(spark, folder), dedupe=False)
    return lists.select("id", "part", joined())


SMALL = 3


@register
def adjacency_lists_small_parts(spark: SparkSession, folder: str) -> DataFrame:
    lists = adjacency.adjacency_lists(graphs.part_supp(spark, folder), dedupe=False, list_limit=SMALL)
    return lists.select("id", "part", joined())


@register
def neighbor_order_small_parts(spark: SparkSession, folder: str) -> DataFrame:
    lists = adjacency.adjacency_lists(graphs.part_supp_numbers(spark, folder), list_limit=SMALL)
    return lists.select("id", "part", joined())


@register
def adjacency_of_links(spark: SparkSession, folder: str) -> DataFrame:
    """Lists built from the links of a prepared graph, in their buckets."""
    return prepare(graphs.part_supp(spark, folder), names=True).adjacency_lists().select("id", "part", joined())


@register
def adjacency_of_links_small_parts(spark: SparkSession, folder: str) -> DataFrame:
    graph = prepare(graphs.part_supp_numbers(spark, folder), dedupe=False, names=True)
    return graph.without_copies().adjacency_lists(SMALL).select("id", "part", joined())


@register
def node_order(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(edges.node_set(graphs.part_supp_numbers(spark, folder)))


@register
def node_order_text(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(edges.node_set(graphs.page_links(spark, folder)))


def _numbered(nodes: DataFrame) -> DataFrame:
    space = Workspace(nodes.sparkSession)
    stored = space.save(nodes, "node_set")
    return ranking.number_rows(stored, ranking.node_order_columns(stored), space, "nodes", stage=False)


@register
def neighbor_order(spark: SparkSession, folder: str) -> DataFrame:
    lists = adjacency.adjacency_lists(graphs.part_supp_numbers(spark, folder))
    return lists.select("id", "part", joined())


@register
def explode_adjacency(spark: SparkSession, folder: str) -> DataFrame:
    lines = graphs.item_lines(spark, folder, graphs.RECORD_LINE)
    return adjacency.explode_adjacency(parse_records(lines)[0])


@register
def out_degrees(spark: SparkSession, folder: str) -> DataFrame:
    return edges.out_degrees(edges.dedupe_edges(graphs.page_links(spark, folder)))


@register
def linking_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return edges.linking_nodes(edges.dedupe_edges(graphs.trade(spark, folder)))


@register
def dangling_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return edges.dangling_nodes(graphs.page_links(spark, folder))


@register
def graph_stats(spark: SparkSession, folder: str) -> DataFrame:
    return edges.graph_stats(edges.dedupe_edges(graphs.trade(spark, folder)))


@register
def prepared_graph_stats(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(graphs.part_supp(spark, folder)).stats()


@register
def initial_ranks(spark: SparkSession, folder: str) -> DataFrame:
    space = Workspace(spark)
    nodes = space.save(edges.node_set(graphs.trade(spark, folder)), "node_set")
    return edges.initial_ranks(nodes, nodes.count()).select("id", rounded("rank"))


@register
def initial_dangling_mass(spark: SparkSession, folder: str) -> DataFrame:
    return edges.initial_dangling_mass(graphs.page_links(spark, folder)).select(
        rounded("dangling_mass")
    )


@register
def adjacency_to_ranked(spark: SparkSession, folder: str) -> DataFrame:
    space = Workspace(spark)
    lists = adjacency.adjacency_lists(graphs.part_supp(spark, folder), workspace=space)
    lines = space.save(adjacency_lines(lists), "lines")
    return to_ranked(parse_adjacency(lines)[0])


@register
def prepare_graph(spark: SparkSession, folder: str) -> DataFrame:
    return edges_to_adjacency(graphs.item_lines(spark, folder, graphs.PLAIN_EDGE_LINE))[0]


# One iteration


def _single_step(spark: SparkSession, folder: str) -> tuple[step.Links, DataFrame]:
    """Links of the trade graph, and its start state; the graph is computed and stored once."""
    space = Workspace(spark)
    unique = space.save(edges.dedupe_edges(graphs.trade(spark, folder)), "unique")
    degrees = space.save(edges.out_degrees(unique), "degrees")
    return step.make_links(unique, unique=True), edges.initial_ranks(degrees, degrees.count())


@register
def contributions(spark: SparkSession, folder: str) -> DataFrame:
    links, state = _single_step(spark, folder)
    return step.contributions(links, state).select("src", "dst", rounded("amount"))


@register
def incoming_sums(spark: SparkSession, folder: str) -> DataFrame:
    links, state = _single_step(spark, folder)
    return step.incoming_sums(step.contributions(links, state)).select("dst", rounded("incoming"))


@register
def node_contribution_join(spark: SparkSession, folder: str) -> DataFrame:
    links, state = _single_step(spark, folder)
    sums = step.incoming_sums(step.contributions(links, state))
    return step.join_incoming(state, sums).select(
        "id", "out_degree", rounded("rank"), rounded("incoming")
    )


@register
def rank_step(spark: SparkSession, folder: str) -> DataFrame:
    result = rank(prepare(graphs.trade(spark, folder), stage=True), tol=None, max_iter=1)
    return result.ranked_nodes.select("id", "out_degree", rounded("rank"))


@register
def next_dangling_mass(spark: SparkSession, folder: str) -> DataFrame:
    result = rank(prepare(graphs.trade(spark, folder), stage=True), tol=None, max_iter=1)
    return metrics.dangling_mass(result.ranked_nodes).select(rounded("dangling_mass"))


@register
def unknown_targets_drop(spark: SparkSession, folder: str) -> DataFrame:
    return _unknown_targets(spark, folder, "drop")


@register
def unknown_targets_materialize(spark: SparkSession, folder: str) -> DataFrame:
    return _unknown_targets(spark, folder, "materialize")


def _unknown_targets(spark: SparkSession, folder: str, policy: str) -> DataFrame:
    graph = prepare_records(graphs.page_records(spark, folder))
    result = rank(graph, tol=None, max_iter=2, unknown_targets=policy)
    return result.ranked_nodes.select("id", "out_degree", rounded("rank"))


# Loop


def _trade_run(spark: SparkSession, folder: str, iterations: int, **options: object) -> RankResult:
    graph = prepare(graphs.trade(spark, folder), stage=True)
    return rank(graph, tol=None, max_iter=iterations, **options)


def _page_run(spark: SparkSession, folder: str, **options: object) -> RankResult:
    return rank(prepare(graphs.page_links(spark, folder), stage=True), max_iter=100, **options)


@register
def rank_fixed_iterations(spark: SparkSession, folder: str) -> DataFrame:
    return _trade_run(spark, folder, 10).ranks.select("id", rounded("rank"))


@register
def rank_until_converged(spark: SparkSession, folder: str) -> DataFrame:
    return _page_run(spark, folder).ranks.select("id", rounded("rank"))


@register
def rank_until_converged_l1(spark: SparkSession, folder: str) -> DataFrame:
    result = _page_run(spark, folder, tol=1e-8, rule="l1", first_iteration_can_converge=True)
    return result.ranks.select("id", rounded("rank"))


@register
def rank_multigraph(spark: SparkSession, folder: str) -> DataFrame:
    graph = prepare(graphs.nation_trade(spark, folder), dedupe=False)
    return rank(graph, tol=None, max_iter=5).ranks.select("id", rounded("rank"))


@register
def rank_resume(spark: SparkSession, folder: str) -> DataFrame:
    first = _trade_run(spark, folder, 5)
    second = rank(first.graph, tol=None, max_iter=5, initial_ranks=first.ranks)
    return second.ranks.select("id", rounded("rank"))


@register
def rank_resume_materialize(spark: SparkSession, folder: str) -> DataFrame:
    """Two iterations and two more, over page records whose unknown targets become nodes."""
    graph = prepare_records(graphs.page_records(spark, folder))
    first = rank(graph, tol=None, max_iter=2, unknown_targets="materialize")
    second = rank(graph, tol=None, max_iter=2, unknown_targets="materialize", initial_ranks=first.ranks, n=first.n, first_iteration=3)
    return second.ranked_nodes.select("id", "out_degree", rounded("rank"))


@register
def rank_resume_converged(spark: SparkSession, folder: str) -> DataFrame:
    """The history of a run stopped after 2 iterations and taken up again until it converges."""
    first = rank(prepare(graphs.page_links(spark, folder), stage=True), max_iter=2)
    second = rank(first.graph, max_iter=100, initial_ranks=first.ranks, first_iteration=3, history=first.history)
    return _history(second.history)


@register
def rank_reopen(spark: SparkSession, folder: str) -> DataFrame:
    """A run in a named workspace, gone on with from what is stored there."""
    name = f"reopened_{uuid.uuid4().hex[:8]}"
    graph = prepare(graphs.trade(spark, folder), workspace=Workspace(spark, name=name), stage=True)
    rank(graph, tol=None, max_iter=4)
    return resume(spark, name, max_iter=10).ranks.select("id", rounded("rank"))


@register
def rank_resume_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Two graphs ranked in one named workspace, 6 iterations and then 2: resumed is the second run, up to 5."""
    name = f"journal_{uuid.uuid4().hex[:8]}"
    space = Workspace(spark, name=name)
    rank(prepare(graphs.part_supp(spark, folder), workspace=space), tol=None, max_iter=6)
    rank(prepare(graphs.trade(spark, folder), workspace=space, stage=True), tol=None, max_iter=2)
    return resume(spark, name, max_iter=5).ranks.select("id", rounded("rank"))


@register
def run_journal(spark: SparkSession, folder: str) -> DataFrame:
    """What the journal of a named workspace knows of its runs."""
    name = f"journal_{uuid.uuid4().hex[:8]}"
    graph = prepare(graphs.page_links(spark, folder), workspace=Workspace(spark, name=name), stage=True)
    rank(graph, max_iter=100)
    first = rank(graph, tol=None, max_iter=2, damping=0.5)
    rank(graph, tol=None, max_iter=3, damping=0.5, initial_ranks=first.ranks, first_iteration=3, history=first.history)
    return runs(spark, name)


@register
def rank_history(spark: SparkSession, folder: str) -> DataFrame:
    result = _trade_run(spark, folder, 4, keep_history=True)
    path = f"{result.graph.workspace.location}/history"
    write_history(result.snapshots(), path)
    return spark.read.parquet(path).select(
        F.col("iteration").cast("long").alias("iteration"), "id", rounded("rank")
    )


# Metrics


@register
def rank_total(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.rank_total(_trade_run(spark, folder, 3).ranks).select(
        rounded("total_rank"), rounded("error")
    )


def _deltas(spark: SparkSession, folder: str) -> DataFrame:
    result = _trade_run(spark, folder, 4, keep_history=True)
    return result.delta(4, 3)


@register
def rank_delta(spark: SparkSession, folder: str) -> DataFrame:
    return _deltas(spark, folder).select(
        "id", rounded("rank"), rounded("previous_rank"), rounded("delta")
    )


@register
def rank_delta_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.delta_summary(_deltas(spark, folder)).select(
        rounded("max_delta"), rounded("avg_delta")
    )


@register
def rank_delta_l1(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.delta_summary(_deltas(spark, folder)).select(rounded("l1_delta"), "nodes")


def _history(history: DataFrame) -> DataFrame:
    measures = ("total_rank", "dangling_mass", "max_delta", "avg_delta", "l1_delta")
    return history.select(F.col("iteration").cast("long").alias("iteration"), *map(rounded, measures), "converged")


@register
def convergence_history(spark: SparkSession, folder: str) -> DataFrame:
    return _history(_page_run(spark, folder).history)


@register
def iteration_metrics(spark: SparkSession, folder: str) -> DataFrame:
    result = _trade_run(spark, folder, 4, keep_history=True)
    return metrics.iteration_metrics(result.snapshot(4), result.snapshot(3)).select(
        "nodes",
        rounded("total_rank"),
        rounded("error"),
        rounded("dangling_mass"),
        rounded("max_delta"),
        rounded("avg_delta"),
        "converged",
    )


@register
def iteration_metrics_l1(spark: SparkSession, folder: str) -> DataFrame:
    result = _trade_run(spark, folder, 4, keep_history=True)
    found = metrics.iteration_metrics(result.snapshot(4), result.snapshot(3), tol=0.5, rule="l1")
    return found.select("nodes", rounded("l1_delta"), "converged")


def _page_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    graph = prepare(graphs.page_links(spark, folder), stage=True)
    return rank(graph, tol=None, max_iter=4, keep_history=True).snapshots()


@register
def history_of_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return _history(metrics.history_of_snapshots(_page_snapshots(spark, folder)))


@register
def history_of_snapshots_l1(spark: SparkSession, folder: str) -> DataFrame:
    return _history(metrics.history_of_snapshots(_page_snapshots(spark, folder), tol=0.1, rule="l1"))


@register
def history_of_stored_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a history on disk that is read in its buckets."""
    graph = prepare(graphs.page_links(spark, folder), stage=True)
    result = rank(graph, tol=None, max_iter=4, keep_history=True)
    path = f"{graph.workspace.location}/stored_history"
    store_history(result, path)
    return _history(metrics.history_of_snapshots(open_history(graph.workspace, path), by="key"))


@register
def compare_runs_all_places(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the places of all nodes."""
    graph = prepare(graphs.trade(spark, folder), dedupe=False, stage=True)
    unique = rank(graph.without_copies(), tol=None, max_iter=3)
    multi = rank(graph, tol=None, max_iter=3)
    # Ranks that differ in their last digits only are not ordered by SQL as they are here.
    return compare(unique, multi, 10**12).select(
        "id", rounded("rank"), rounded("previous_rank"), rounded("delta"), (F.col("place") > 0).alias("placed"), (F.col("other_place") > 0).alias("other_placed")
    )


@register
def top_k_positions_all(spark: SparkSession, folder: str) -> DataFrame:
    """Positions of all nodes, numbered by ranges of their order."""
    ranks = _trade_run(spark, folder, 5).ranks.withColumn("rank", F.round("rank", 12))
    return ranking.top_k_positions(ranks, 10**12).select("position", "id", rounded("rank"))


@register
def compare_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks with and without copies of edges, and places among the first 20 (0 for none)."""
    graph = prepare(graphs.trade(spark, folder), dedupe=False, stage=True)
    unique = rank(graph.without_copies(), tol=None, max_iter=3)
    multi = rank(graph, tol=None, max_iter=3)
    return compare(unique, multi, 20).select(
        "id", rounded("rank"), rounded("previous_rank"), rounded("delta"), "place", "other_place"
    )


# Orderings


@register
def top_k(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_k(_trade_run(spark, folder, 5).ranks, 20).select("id", rounded("rank"))


@register
def top_k_positions(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_k_positions(_trade_run(spark, folder, 5).ranks, 10).select(
        "position", "id", rounded("rank")
    )


@register
def top_k_ties(spark: SparkSession, folder: str) -> DataFrame:
    """All ranks are equal in the complete graph of nations; k is larger than the graph."""
    graph = prepare(graphs.nation_trade(spark, folder))
    ranks = rank(graph, max_iter=2).ranks.withColumn("rank", F.round("rank", 12))
    return ranking.top_k_positions(ranks, 50).select("position", "id", rounded("rank"))


@register
def ranking_full(spark: SparkSession, folder: str) -> DataFrame:
    result = _trade_run(spark, folder, 5)
    # Equal ranks may differ in their last digits, which must not decide their order here.
    order = [F.desc(F.round("rank", 12)), F.asc("id")]
    numbered = ranking.number_rows(result.ranks, order, result.graph.workspace, "ordered")
    return numbered.select("position", "id", rounded("rank"))


@register
def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    result = _trade_run(spark, folder, 3, keep_history=True)
    path = f"{result.graph.workspace.location}/history"
    write_history(result.snapshots(), path)
    return ranking.latest_snapshot(spark.read.parquet(path)).select(
        F.col("iteration").cast("long").alias("iteration"), "id", rounded("rank")
    )


# Sinks and reports


@register
def ranks_text_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _roundtrip(spark, folder, adjacency.LIST_LIMIT).select("id", rounded("rank"), joined())


@register
def ranks_text_roundtrip_small_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Each neighbour that was written and read back, with the rank of its node; lists came in parts of 3."""
    back = _roundtrip(spark, folder, SMALL)
    return back.select("id", rounded("rank"), F.explode_outer("neighbors").alias("neighbor"))


def _ranked_text(spark: SparkSession, folder: str, list_limit: int) -> str:
    """The folder of ranked lines after 3 iterations, lists built from the stored links and cut after ``list_limit`` neighbours."""
    result = rank(prepare(graphs.part_supp(spark, folder), names=True), tol=None, max_iter=3)
    space = result.graph.workspace
    lists = space.save(result.graph.adjacency_lists(list_limit).drop("key"), space.new_name("lists"))
    path = f"{space.location}/ranks_text"
    write_ranked(result.ranked_nodes, lists, path, space)
    return path


def _roundtrip(spark: SparkSession, folder: str, list_limit: int) -> DataFrame:
    return read_ranked(spark, _ranked_text(spark, folder, list_limit))


@register
def text_parts_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of 3 neighbours, numbered by the reader from where their lines stand in the files."""
    return read_parts(spark, _ranked_text(spark, folder, SMALL), (3,)).select("id", "part", joined())


@register
def rank_total_of_text(spark: SparkSession, folder: str) -> DataFrame:
    """Total rank of files in which every part of a list repeats the rank of its node."""
    ranks = ranked_nodes_of(read_ranked(spark, _ranked_text(spark, folder, SMALL)))
    return metrics.rank_total(ranks).select(rounded("total_rank"), rounded("error"))


@register
def top_k_of_text(spark: SparkSession, folder: str) -> DataFrame:
    ranks = ranked_nodes_of(read_ranked(spark, _ranked_text(spark, folder, SMALL)))
    return ranking.top_k(ranks.withColumn("rank", F.round("rank", 12)), 20).select("id", rounded("rank"))


@register
def adjacency_text_parts_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Edge lines to an adjacency file with parts of 3, read back with their numbers."""
    space = Workspace(spark)
    lines = edges_to_adjacency(graphs.item_lines(spark, folder, graphs.PLAIN_EDGE_LINE), workspace=space, list_limit=SMALL)[0]
    path = f"{space.location}/adjacency_text"
    write_lines(lines, path)
    return read_parts(spark, path, (2,), space).select("id", "part", joined())


@register
def ranked_file_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Ranked records of iterations 4 and 3, parts of 3, checked as they are in the files."""
    graph = prepare(graphs.trade(spark, folder), stage=True, names=True)
    result, space = rank(graph, tol=None, max_iter=4, keep_history=True), graph.workspace
    lists = space.save(graph.adjacency_lists(SMALL).drop("key"), space.new_name("lists"))
    for i in (3, 4):
        write_ranked(result.snapshot(i), lists, f"{space.location}/iter{i}", space)
    found = check_ranked_files(spark, f"{space.location}/iter4", f"{space.location}/iter3", workspace=space)
    return found.select("nodes", *map(rounded, ("total_rank", "error", "dangling_mass", "max_delta", "avg_delta", "l1_delta")), "converged")


@register
def top_report_csv(spark: SparkSession, folder: str) -> DataFrame:
    result = _trade_run(spark, folder, 5)
    path = f"{result.graph.workspace.location}/top"
    write_csv(top_report(result.ranks, 20), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(
        F.col("Node").alias("node"), F.round(F.col("Rank").cast("double"), 10).alias("rank")
    )


@register
def convergence_report_csv(spark: SparkSession, folder: str) -> DataFrame:
    result = _page_run(spark, folder)
    path = f"{result.graph.workspace.location}/convergence"
    write_csv(convergence_report(result.history), path)
    back = spark.read.option("header", True).csv(path)

    def number(name: str) -> Column:
        return F.round(F.when(F.col(name) != "inf", F.col(name).cast("double")), 10)

    return back.select(
        F.col("Iteration").cast("long").alias("iteration"),
        number("TotalRank").alias("total_rank"),
        number("DanglingMass").alias("dangling_mass"),
        number("MaxDelta").alias("max_delta"),
        number("AverageDelta").alias("average_delta"),
        F.col("Converged").alias("converged"),
    )


@register
def run_summary_(spark: SparkSession, folder: str) -> DataFrame:
    return run_summary(_page_run(spark, folder), "page_links").select(
        "implementation",
        "dataset",
        "nodes",
        "damping",
        "iterations",
        "converged",
        rounded("total_rank"),
    )


@register
def run_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs in one ledger; the seconds differ from run to run and are left out."""
    result = _trade_run(spark, folder, 2)
    path = f"{result.graph.workspace.location}/ledger"
    append_ledger(run_summary(result, "trade"), path)
    append_ledger(run_summary(rank(result.graph, tol=None, max_iter=3), "trade"), path)
    return spark.read.parquet(path).select("engine", "dataset", "num_nodes", "iterations")


@register
def run_ledger_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The same ledger as CSV with one header."""
    result = _trade_run(spark, folder, 2)
    path = f"{result.graph.workspace.location}/ledger"
    append_ledger(run_summary(result, "trade"), path)
    append_ledger(run_summary(rank(result.graph, tol=None, max_iter=3), "trade"), path)
    write_ledger_csv(spark.read.parquet(path), f"{path}_csv")
    back = spark.read.option("header", True).csv(f"{path}_csv")
    return back.select("engine", "dataset", F.col("num_nodes").cast("long").alias("num_nodes"), F.col("iterations").cast("long").alias("iterations"))
