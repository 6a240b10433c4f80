"""A whole run from files to files: ranks, top list, convergence table, times and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from linkrank.operators.adjacency import LIST_LIMIT, adjacency_lists
from linkrank.operators.edges import initial_ranks
from linkrank.operators.metrics import iteration_metrics
from linkrank.operators.ranking import node_order_columns, order_nodes
from linkrank.plans.graph import prepare, prepare_records
from linkrank.plans.history import store_history
from linkrank.plans.iterate import RankResult, rank
from linkrank.plans.workspace import Workspace
from linkrank.sinks import (
    adjacency_lines,
    append_ledger,
    convergence_report,
    ranked_lines,
    ranked_records,
    run_summary,
    times_report,
    top_report,
    write_csv,
    write_lines,
    write_summary,
)
from linkrank.sources import (
    POSITION,
    check_edges,
    check_records,
    lines_in_order,
    number_parts,
    ranked_nodes_of,
    read_ranked,
    reject_counts,
    split_checked,
)

SOURCES = ("edges", "adjacency", "ranked")
#: Allowed numbers of fields in a record of each kind.
WIDTHS = {"adjacency": (2,), "ranked": (3,)}


def edges_to_adjacency(lines: DataFrame, dedupe: bool = True, workspace: Workspace | None = None, list_limit: int = LIST_LIMIT, **edge_format: str | None) -> tuple[DataFrame, DataFrame]:
    """Adjacency lines of an edge list, in the order of their ids and parts, and the rejects; the lines are read once."""
    workspace = workspace or Workspace(lines.sparkSession)
    edges, rejects = split_checked(workspace.save(check_edges(lines, **edge_format), workspace.new_name("checked"), apart="reason"))
    lists = workspace.save(adjacency_lists(edges, dedupe, list_limit, workspace, stage=False), workspace.new_name("lists"))
    return adjacency_lines(order_nodes(lists)), rejects


def adjacency_to_ranked(records: DataFrame, n: int | None = None) -> DataFrame:
    """Ranked lines with the rank ``1/N`` of adjacency records ``(id, neighbors)``.

    N is ``n`` where it is known; else the ids are counted, each once however many records it has.
    """
    total = n if n is not None else records.select("id").distinct().count()
    return ranked_lines(initial_ranks(records.select("id", "neighbors"), max(total, 1)))


def write_ranked(ranked_nodes: DataFrame, lists: DataFrame, path: str, workspace: Workspace, order: list[Column] | None = None) -> None:
    """Ranks ``(id, rank)`` and lists ``(id, part, neighbors)`` as ranked lines, by id and part; ``read_parts`` reads them as they were.

    The records are stored first, so that finding the ranges of their order doesn't compute them a second time.
    """
    name = workspace.new_name("ranked")
    records = workspace.save(ranked_records(ranked_nodes, lists), name)
    write_lines(ranked_lines(order_nodes(records, order)), path)
    workspace.drop(name)


def check_ranked_files(spark: SparkSession, current: str, previous: str | None = None, tol: float = 1e-6, rule: str = "max", workspace: Workspace | None = None) -> DataFrame:
    """``iteration_metrics`` of the ranked records in ``current`` against those in ``previous``, from the files as they are.

    The out-degree of a node is the number of neighbours in all its parts, and its rank counts once. A file without a valid record is
    an error, as is a node whose parts disagree about its rank.
    """
    workspace = workspace or Workspace(spark)
    nodes = [workspace.save(ranked_nodes_of(read_ranked(spark, path)), workspace.new_name("nodes")) for path in (current, previous) if path is not None]
    return iteration_metrics(*nodes, tol=tol, rule=rule)


def rank_files(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    source: str = "edges",
    dedupe: bool = True,
    k: int = 20,
    text: bool = True,
    dataset: str | None = None,
    ledger_path: str | None = None,
    edge_format: dict[str, str | None] | None = None,
    resume_from: str | None = None,
    workspace: str | None = None,
    list_limit: int = LIST_LIMIT,
    **options: object,
) -> RankResult:
    """Rank the graph in ``input_path`` and write reports below ``output_path``.

    ``source`` tells whether the lines are edges, adjacency records, or ranked records of an earlier
    iteration, from which the run goes on; several records of an id are parts of its list. ``resume_from`` is the
    output folder of an earlier run over the same input: its ranks in full precision, its N, its number of iterations and
    its history are taken up, and the outcome is that of one run. Ranked records alone have 15 decimals and know
    no N; give ``n`` and ``first_iteration`` where the count of records is not the N of the run.
    ``workspace`` names a workspace to be kept, in which ``linkrank.resume`` goes on after the driver died.
    ``edge_format`` goes to the edge parser, ``list_limit`` to the lists built from edges, and ``options`` to ``rank``.

    Written are ``ranks``, ``history`` and ``run`` (Parquet), ``final`` (ranked records in the order of ids and parts, unless ``text`` is
    false), ``rejects`` (Parquet) and ``reject_counts``, ``top``, ``convergence``, ``times``, ``summary``; and if history is kept
    ``iterations`` (Parquet) and the ranked records of each iteration as ``iter1``, ``iter2`` and so on.

    The checked lines are stored once, rejected ones apart from the others, and dropped as soon as the graph has what it needs.
    """
    if source not in SOURCES:
        raise ValueError(f"source must be one of {SOURCES}, not {source!r}")
    space = Workspace(spark, name=workspace)
    stored = space.new_name("checked")
    if source == "edges":
        checked = check_edges(spark.read.text(input_path), **(edge_format or {}))
    else:
        checked = check_records(lines_in_order(spark, input_path), WIDTHS[source], POSITION)
    read, rejects = split_checked(space.save(checked, stored, apart="reason"))
    rejects.write.parquet(f"{output_path}/rejects")
    write_csv(reject_counts(spark.read.schema(rejects.schema).parquet(f"{output_path}/rejects")), f"{output_path}/reject_counts")
    if source == "edges":
        graph = prepare(read, dedupe=dedupe, workspace=space, names=text)
        lists = space.save(graph.adjacency_lists(list_limit).drop("key"), space.new_name("lists")) if text else None
    else:
        if source == "ranked" and read.isEmpty():
            raise ValueError(f"no valid ranked records in {input_path}")
        graph = prepare_records(read, space)
        lists = space.save(number_parts(read.drop("rank"), space), space.new_name("lists")) if text else None
        if source == "ranked" and resume_from is None:
            # Parts of one list repeat the rank of their node.
            ranks = ranked_nodes_of(read).select("id", "rank")
            options["initial_ranks"] = space.save(ranks, space.new_name("given"))
    space.drop(stored)
    if resume_from is not None:
        earlier = spark.read.parquet(f"{resume_from}/run").first()
        options |= {
            "initial_ranks": spark.read.parquet(f"{resume_from}/ranks"), "history": spark.read.parquet(f"{resume_from}/history"),
            "n": earlier["n"], "first_iteration": earlier["iterations"] + 1,
        }
    result = rank(graph, **options)

    result.ranks.write.parquet(f"{output_path}/ranks")
    result.history.coalesce(1).write.parquet(f"{output_path}/history")
    spark.createDataFrame([(result.n, result.iterations)], "n long, iterations long").coalesce(1).write.parquet(f"{output_path}/run")
    if text:
        order = node_order_columns(graph.nodes.select("id"))
        write_ranked(result.ranked_nodes, lists, f"{output_path}/final", space, order)
        for iteration in result.snapshot_tables if options.get("keep_history") else ():
            write_ranked(result.snapshot(iteration), lists, f"{output_path}/iter{iteration}", space, order)
    write_csv(top_report(result.ranks, k), f"{output_path}/top")
    write_csv(convergence_report(result.history), f"{output_path}/convergence")
    write_csv(times_report(result.history), f"{output_path}/times")
    summary = run_summary(result, dataset or input_path)
    write_summary(summary, f"{output_path}/summary")
    if options.get("keep_history"):
        store_history(result, f"{output_path}/iterations")
    if ledger_path is not None:
        append_ledger(summary, ledger_path)
    return result
