"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the test tables, ``BENCH_CPUS`` the number of local cores. Every query writes
its whole result to a sink that discards it, so nothing is left out by column pruning or limits.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from linkrank import RankResult, Workspace, prepare, rank  # noqa: E402
from linkrank.operators import adjacency, edges, step  # noqa: E402
from linkrank.sources import parse_edges, parse_records  # noqa: E402
from queries import graphs, queries  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# The four-node example graph, whose published run took 293 s for 16 iterations.
EXAMPLE = [("A", "B"), ("A", "C"), ("A", "D"), ("B", "C"), ("C", "A"), ("C", "D")]


def session() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("linkrank-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def benchmarks(spark: SparkSession, loops: dict[str, dict]) -> dict[str, Callable[[], None]]:
    def run(name: str, source: DataFrame, dedupe: bool = True, **options: object) -> None:
        graph = prepare(source, dedupe=dedupe, stage=True)
        result: RankResult = rank(graph, **options)
        drain(result.ranks)
        loops[name] = {
            "nodes": graph.n,
            "edges": graph.n_edges,
            "iterations": result.iterations,
            "prepare_sec": round(graph.seconds, 3),
            "sec_per_iteration": round(
                sum(row[-1] for row in result.history_rows) / result.iterations, 3
            ),
            "total_rank": result.history_rows[-1][1],
        }
        result.close()

    def one_step() -> None:
        with Workspace(spark) as space:
            unique = space.save(edges.dedupe_edges(part_supp), "unique")
            degrees = space.save(edges.out_degrees(unique), "degrees")
            state = edges.initial_ranks(degrees, degrees.count())
            drain(step.incoming_sums(step.contributions(step.make_links(unique, unique=True), state)))

    def registered(name: str) -> Callable[[], None]:
        return lambda: drain(queries()[name](spark, FOLDER))

    part_supp = graphs.part_supp(spark, FOLDER)
    return {
        "example_until_converged": lambda: run(
            "example_until_converged", spark.createDataFrame(EXAMPLE, "src string, dst string")
        ),
        "part_supp_20_iterations": lambda: run(
            "part_supp_20_iterations", part_supp, tol=None, max_iter=20
        ),
        "part_supp_multigraph_10_iterations": lambda: run(
            "part_supp_multigraph_10_iterations", part_supp, False, tol=None, max_iter=10
        ),
        "trade_10_iterations": lambda: run(
            "trade_10_iterations", graphs.trade(spark, FOLDER), tol=None, max_iter=10
        ),
        "page_links_until_converged": lambda: run(
            "page_links_until_converged", graphs.page_links(spark, FOLDER), max_iter=100
        ),
        "parse_edges": lambda: drain(
            parse_edges(graphs.item_lines(spark, FOLDER, graphs.EDGE_LINE))[0]
        ),
        "parse_records": lambda: drain(
            parse_records(graphs.item_lines(spark, FOLDER, graphs.RECORD_LINE))[0]
        ),
        "dedupe_edges": lambda: drain(edges.dedupe_edges(part_supp)),
        "graph_stats": lambda: drain(edges.graph_stats(edges.dedupe_edges(part_supp))),
        "adjacency_lists": lambda: drain(adjacency.adjacency_lists(part_supp)),
        "single_step": one_step,
        **{name: registered(name) for name in ("prepare_graph", "adjacency_of_links", "ranks_text_roundtrip", "ranking_full", "compare_runs", "compare_runs_all_places", "history_of_stored_snapshots")},
    }


def main() -> None:
    spark = session()
    loops: dict[str, dict] = {}
    seconds: dict[str, float] = {}
    # Start the executors and compile the common code before anything is timed.
    rank(prepare(spark.createDataFrame(EXAMPLE, "src string, dst string")), max_iter=2).close()
    for name, query in benchmarks(spark, loops).items():
        started = time.perf_counter()
        query()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all benchmark queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "loops": loops,
            }
        )
    )


if __name__ == "__main__":
    main()
