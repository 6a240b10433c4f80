"""The four-node example, against its published ranks and metrics."""

import pytest
from conftest import edge_frame, lines
from pyspark.sql import functions as F

import golden
from linkrank import prepare, prepare_records, rank
from linkrank.operators.adjacency import adjacency_lists
from linkrank.operators.metrics import (
    dangling_mass,
    history_of_snapshots,
    iteration_metrics,
    rank_total,
)
from linkrank.operators.ranking import latest_snapshot, order_nodes, top_k_positions
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
    write_history,
    write_lines,
    write_summary,
)
from linkrank.sources import parse_adjacency, parse_edges, read_ranked

TOLERANCE = 5e-15


@pytest.fixture(scope="module")
def edges(spark):
    return parse_edges(lines(spark, *golden.EDGE_LINES))[0]


@pytest.fixture(scope="module")
def result(spark, edges):
    run = rank(prepare(edges), keep_history=True)
    yield run
    run.close()


def test_edge_list_becomes_adjacency_file(spark, edges, tmp_path):
    records = order_nodes(adjacency_lists(edges))
    assert [r.value for r in adjacency_lines(records).collect()] == golden.ADJACENCY_LINES


def test_every_iteration(result):
    rows = result.snapshots().collect()
    assert len(rows) == 64
    for row in rows:
        expected = golden.RANKS[row.iteration - 1][golden.IDS.index(row.id)]
        assert row["rank"] == pytest.approx(expected, abs=TOLERANCE)


def test_adjacency_source_gives_the_same_ranks(spark, result):
    records = parse_adjacency(lines(spark, *golden.ADJACENCY_LINES))[0]
    other = rank(prepare_records(records))
    assert other.iterations == result.iterations
    expected = {r.id: r["rank"] for r in result.ranks.collect()}
    for row in other.ranks.collect():
        assert row["rank"] == pytest.approx(expected[row.id], abs=TOLERANCE)
    other.close()


def test_convergence_table(result):
    history = result.history.collect()
    assert result.iterations == 16 and result.converged
    assert [r.converged for r in history] == [False] * 15 + [True]
    assert history[0].max_delta is None and history[0].avg_delta is None
    for iteration, (largest, average) in golden.DELTAS.items():
        assert history[iteration - 1].max_delta == pytest.approx(largest, abs=TOLERANCE)
        assert history[iteration - 1].avg_delta == pytest.approx(average, abs=TOLERANCE)
    for row in history:
        ranks = golden.RANKS[row.iteration - 1]
        assert row.total_rank == pytest.approx(1.0, abs=1e-14)
        assert row.dangling_mass == pytest.approx(ranks[3], abs=TOLERANCE)


def test_other_stop_rules(spark, edges):
    graph = prepare(edges)
    by_max = rank(graph, first_iteration_can_converge=True)
    assert by_max.iterations == 16
    assert by_max.history_rows[0][3] == pytest.approx(0.123958333, abs=1e-9)
    by_sum = rank(graph, tol=1e-8, rule="l1", max_iter=100, first_iteration_can_converge=True)
    assert by_sum.iterations == 23 and by_sum.converged
    graph.workspace.close()


def test_metrics_of_the_final_ranks(result):
    total = rank_total(result.ranks).first()
    assert total.total_rank == pytest.approx(1.0, abs=1e-14) and total.error < 1e-14
    assert dangling_mass(result.ranked_nodes).first()[0] == pytest.approx(
        0.296318896514135, abs=TOLERANCE
    )


def test_metrics_of_stored_iterations(result):
    first = iteration_metrics(result.snapshot(1)).first()
    assert (first.nodes, first.max_delta, first.avg_delta, first.converged) == (4, None, None, False)
    last = iteration_metrics(result.snapshot(16), result.snapshot(15)).first()
    assert last.converged and last.error < 1e-14
    assert (last.max_delta, last.avg_delta) == pytest.approx(golden.DELTAS[16], abs=TOLERANCE)
    assert last.dangling_mass == pytest.approx(golden.RANKS[15][3], abs=TOLERANCE)

    rows = history_of_snapshots(result.snapshots()).orderBy("iteration").collect()
    for found, seen in zip(rows, result.history.collect(), strict=True):
        for name in ("iteration", "converged"):
            assert found[name] == seen[name]
        for name in ("total_rank", "dangling_mass", "max_delta", "avg_delta", "l1_delta"):
            assert found[name] == pytest.approx(seen[name], abs=1e-14)


def test_times(result):
    times = times_report(result.history)
    assert times.columns == ["Iteration", "Seconds"] and times.count() == 16


def test_top_list(result):
    rows = top_k_positions(result.ranks, 20).orderBy("position").collect()
    assert [r.position for r in rows] == [1, 2, 3, 4]
    assert [r.id for r in rows] == golden.TOP


def test_reports(spark, result, tmp_path):
    write_csv(top_report(result.ranks), str(tmp_path / "top"))
    top = spark.read.option("header", True).csv(str(tmp_path / "top")).collect()
    assert [r.Node for r in top] == golden.TOP
    assert len(top[0].Rank) == len("0.306894534910765")
    assert float(top[0].Rank) == pytest.approx(0.306894534910765, abs=TOLERANCE)

    write_csv(convergence_report(result.history), str(tmp_path / "convergence"))
    rows = spark.read.option("header", True).csv(str(tmp_path / "convergence")).collect()
    assert len(rows) == 16
    assert (rows[0].MaxDelta, rows[0].AverageDelta, rows[0].Converged) == ("inf", "inf", "NO")
    assert rows[15].Converged == "YES"
    assert float(rows[15].DanglingMass) == pytest.approx(0.296318896514135, abs=TOLERANCE)
    assert rows[15].MaxDelta.startswith("9.6460704") and rows[15].MaxDelta.endswith("e-07")

    named = top_report(result.ranks, 2, columns=("page", "score"))
    assert named.columns == ["page", "score"] and named.count() == 2


def test_summary_and_ledger(spark, result, tmp_path):
    summary = run_summary(result, "example")
    row = summary.first()
    assert (row.nodes, row.iterations, row.converged) == (4, 16, True)
    write_summary(summary, str(tmp_path / "summary"))
    text = [r.value for r in spark.read.text(str(tmp_path / "summary")).collect()]
    assert "dataset=example" in text and "iterations=16" in text
    for _ in range(2):
        append_ledger(summary, str(tmp_path / "ledger"))
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    assert ledger.columns == ["engine", "dataset", "num_nodes", "iterations", "seconds"]
    assert ledger.count() == 2


def test_text_round_trip(spark, edges, result, tmp_path):
    records = ranked_records(result.ranked_nodes, adjacency_lists(edges))
    path = str(tmp_path / "ranks")
    write_lines(ranked_lines(records.orderBy("id")), path)
    written = sorted(r.value for r in spark.read.text(path).collect())
    assert written[3].startswith("D\t0.29631889651413") and written[3].endswith("\t")
    back = {r.id: r for r in read_ranked(spark, path).collect()}
    assert back["A"].neighbors == ["B", "C", "D"] and back["D"].neighbors == []
    assert back["C"]["rank"] == pytest.approx(0.306894534910765, abs=TOLERANCE)


def test_resume_from_a_snapshot(spark, edges, result):
    graph = prepare(edges)
    resumed = rank(graph, tol=None, max_iter=5, initial_ranks=result.snapshot(5))
    got = {r.id: r["rank"] for r in resumed.ranks.collect()}
    for id_, expected in zip(golden.IDS, golden.RANKS[9], strict=True):
        assert got[id_] == pytest.approx(expected, abs=TOLERANCE)
    graph.workspace.close()


def test_history_sink_and_latest_snapshot(spark, result, tmp_path):
    path = str(tmp_path / "history")
    write_history(result.snapshots(), path)
    latest = latest_snapshot(spark.read.parquet(path))
    rows = latest.orderBy("id").collect()
    assert {r.iteration for r in rows} == {16}
    assert [r["rank"] for r in rows] == pytest.approx(list(golden.RANKS[15]), abs=TOLERANCE)


def test_empty_graph_is_an_error(spark):
    with pytest.raises(ValueError, match="no nodes"):
        prepare(edge_frame(spark, []))


def test_scale_of_the_text_format(spark, result):
    line = ranked_lines(
        result.ranks.where("id = 'A'").withColumn("neighbors", F.array(F.lit("x"), F.lit("y")))
    ).first()
    assert line.value.split("\t")[1].startswith("0.2308980544047") and line.value.endswith("\tx,y")
