"""Whole runs from files to files."""

import pytest

import golden
from linkrank import rank_files
from linkrank.operators.adjacency import LIST_LIMIT
from linkrank.sources import read_ranked


def values(spark, path):
    return {r.id: r["rank"] for r in read_ranked(spark, str(path)).collect()}


def test_edges_to_reports_and_on_from_the_last_iteration(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("\n".join(golden.EDGE_LINES))
    out = tmp_path / "out"
    result = rank_files(
        spark,
        str(tmp_path / "edges.txt"),
        str(out),
        dataset="example",
        ledger_path=str(tmp_path / "ledger"),
        keep_history=True,
        tol=None,
        max_iter=4,
    )
    result.close()
    found = values(spark, out / "final")
    assert found == pytest.approx(dict(zip(golden.IDS, golden.RANKS[3], strict=True)), abs=5e-15)
    stored = {r.id: r["rank"] for r in spark.read.parquet(str(out / "ranks")).collect()}
    assert stored == pytest.approx(found, abs=1e-15)
    assert spark.read.parquet(str(out / "iterations")).count() == 16
    for name, rows in (("top", 4), ("convergence", 4), ("times", 4)):
        assert spark.read.option("header", True).csv(str(out / name)).count() == rows
    summary = {r.value for r in spark.read.text(str(out / "summary")).collect()}
    assert {"dataset=example", "nodes=4", "iterations=4", "converged=false"} <= summary
    assert spark.read.parquet(str(tmp_path / "ledger")).first().num_nodes == 4

    on = rank_files(
        spark, str(out / "final"), str(tmp_path / "on"), source="ranked", tol=None, max_iter=2
    )
    on.close()
    assert values(spark, tmp_path / "on" / "final") == pytest.approx(
        dict(zip(golden.IDS, golden.RANKS[5], strict=True)), abs=5e-15
    )


def test_adjacency_files_with_unknown_targets(spark, tmp_path):
    (tmp_path / "graph.txt").write_text("a\tb,zz\nb\ta\n")
    result = rank_files(
        spark,
        str(tmp_path / "graph.txt"),
        str(tmp_path / "out"),
        source="adjacency",
        unknown_targets="materialize",
        tol=None,
        max_iter=1,
    )
    result.close()
    rows = {r.id: r for r in read_ranked(spark, str(tmp_path / "out" / "final")).collect()}
    assert set(rows) == {"a", "b", "zz"}
    assert rows["a"].neighbors == ["b", "zz"] and rows["zz"].neighbors == []
    assert rows["zz"]["rank"] == pytest.approx(0.15 / 2 + 0.85 * 0.25, abs=1e-14)


def test_ranked_files_with_lists_in_parts(spark, tmp_path):
    (tmp_path / "ranks.txt").write_text("a\t0.4\tb\na\t0.4\tc\nb\t0.3\ta\nc\t0.3\t\n")
    result = rank_files(
        spark, str(tmp_path / "ranks.txt"), str(tmp_path / "out"), source="ranked", tol=None, max_iter=1
    )
    result.close()
    lists = {}
    for r in read_ranked(spark, str(tmp_path / "out" / "final")).collect():
        lists[r.id] = sorted(lists.get(r.id, []) + r.neighbors)
        if r.id == "b":
            assert r["rank"] == pytest.approx(0.05 + 0.85 * (0.2 + 0.1), abs=1e-14)
    assert lists == {"a": ["b", "c"], "b": ["a"], "c": []}


def test_a_node_past_the_limit_is_written_and_read_again(spark, tmp_path):
    n = LIST_LIMIT + 1
    (tmp_path / "edges.txt").write_text("\n".join(f"hub\t{i}" for i in range(n)))
    out = tmp_path / "out"
    rank_files(spark, str(tmp_path / "edges.txt"), str(out), tol=None, max_iter=1).close()
    back = read_ranked(spark, str(out / "final"))
    assert back.where("id = 'hub'").count() == 2 and back.selectExpr("sum(size(neighbors))").first()[0] == n
    on = rank_files(spark, str(out / "final"), str(tmp_path / "on"), source="ranked", tol=None, max_iter=1)
    assert on.graph.n == n + 1 and on.graph.n_edges == n
    on.close()


def test_resumed_files_give_the_uninterrupted_run(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("\n".join(golden.EDGE_LINES))
    path = str(tmp_path / "edges.txt")
    rank_files(spark, path, str(tmp_path / "first"), tol=1e-6, max_iter=15).close()
    second = rank_files(spark, path, str(tmp_path / "second"), resume_from=str(tmp_path / "first"), tol=1e-6, max_iter=20)
    assert (second.iterations, second.converged, len(second.history_rows)) == (16, True, 16)
    second.close()
    whole = rank_files(spark, path, str(tmp_path / "whole"), tol=1e-6, max_iter=20)
    stored = [{r.id: r["rank"] for r in spark.read.parquet(str(tmp_path / x / "ranks")).collect()} for x in ("second", "whole")]
    assert stored[0] == pytest.approx(stored[1], abs=1e-16)
    whole.close()


def test_rejected_lines_are_written_and_counted(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("a b\nb\na b c\n# x\n\nb a\n")
    rank_files(spark, str(tmp_path / "edges.txt"), str(tmp_path / "out"), tol=None, max_iter=1).close()
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out" / "rejects")).collect()) == ["a b c", "b"]
    counts = spark.read.option("header", True).csv(str(tmp_path / "out" / "reject_counts")).collect()
    assert [(r.reason, r.lines) for r in counts] == [("wrong field count", "2")]


def test_unknown_source(spark, tmp_path):
    with pytest.raises(ValueError, match="source"):
        rank_files(spark, "x", str(tmp_path), source="matrix")
