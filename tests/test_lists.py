"""Lists in parts: built from stored links, written as text in order, read back with their numbers."""

import random
from collections import defaultdict

import pytest
from conftest import edge_frame

from linkrank import Workspace, check_ranked_files, prepare, prepare_records, rank, write_ranked
from linkrank import files as files_module
from linkrank import rank_files
from linkrank.operators import metrics, ranking
from linkrank.sources import parse_ranked, ranked_nodes_of, read_parts, read_ranked


def hub_pairs(seed=3, targets=60):
    rng = random.Random(seed)
    pairs = [("hub", f"t{i}") for i in range(targets)] + [("hub", "t0")] * 9
    pairs += [(f"n{rng.randrange(20)}", f"n{rng.randrange(20)}") for _ in range(90)] + [(f"t{i}", "hub") for i in range(0, targets, 3)]
    rng.shuffle(pairs)
    return pairs


def whole(rows, limit):
    """Lists put together again; every part but the last one is full."""
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.id, r.part)):
        assert r.part * limit == len(found[r.id]) and len(r.neighbors) <= limit
        found[r.id] += r.neighbors
    return dict(found)


def expected_lists(pairs, dedupe):
    found = defaultdict(list)
    for src, dst in set(pairs) if dedupe else pairs:
        found[src].append(dst)
        found.setdefault(dst, [])
    return {k: sorted(v) for k, v in found.items()}


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("limit", [100_000, 7, 1])
@pytest.mark.parametrize("heavy", [1_000_000, 20])
def test_lists_of_prepared_links(spark, dedupe, limit, heavy):
    pairs = hub_pairs()
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), dedupe=dedupe, workspace=space, heavy_rows=heavy, names=True)
        lists = graph.adjacency_lists(limit)
        assert lists.columns == ["key", "id", "part", "neighbors"]
        assert whole(lists.collect(), limit) == expected_lists(pairs, dedupe)
        assert whole(graph.without_copies().adjacency_lists(limit).collect(), limit) == expected_lists(pairs, True)
        with pytest.raises(ValueError, match="names"):
            prepare(edge_frame(spark, pairs), workspace=space).adjacency_lists()


def test_lists_of_prepared_links_move_no_edge(spark):
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, hub_pairs()).repartition(4), workspace=space, names=True)
        plan = graph.adjacency_lists()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Cartesian" not in plan
        result = rank(graph, tol=None, max_iter=1)
        # The iterations don't read the names.
        assert "dst_id" not in graph.links.light._jdf.queryExecution().executedPlan().toString()
        assert result.ranks.count() == graph.n


def test_lists_of_records_are_those_of_the_members(spark):
    with Workspace(spark) as space:
        records = spark.createDataFrame([("a", ["zz", "b", "b"]), ("b", [])], "id string, neighbors array<string>")
        graph = prepare_records(records, space, names=True)
        assert {r.id: r.neighbors for r in graph.adjacency_lists().collect()} == {"a": ["b", "b", "zz"], "b": []}


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_parts_are_neighbours_in_files_and_read_in_order(spark, tmp_path, partitions):
    pairs = [(str(a), str(b)) for a in range(30) for b in range(a % 11)] + [("5", str(k)) for k in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        with Workspace(spark) as space:
            graph = prepare(edge_frame(spark, pairs), workspace=space, names=True)
            result = rank(graph, tol=None, max_iter=2)
            write_ranked(result.ranked_nodes, graph.adjacency_lists(4).drop("key"), str(tmp_path / "out"), space)
            files = sorted((tmp_path / "out").glob("part-*"))
            lines = [line for f in files for line in f.read_text().splitlines()]
            ids = [int(line.split("\t")[0]) for line in lines]
            assert ids == sorted(ids)
            hub = [line.split("\t")[2].split(",") for line in lines if line.startswith("5\t")]
            assert [x for part in hub for x in part] == sorted({b for a, b in pairs if a == "5"}, key=int) and len(hub) == 100

            back = read_parts(spark, str(tmp_path / "out"), (3,), space)
            found = whole(back.collect(), 4)
            assert found == {k: sorted(v, key=int) for k, v in expected_lists(pairs, True).items()}
            # Small blocks: the lines of a file are read by several tasks.
            spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
            assert whole(read_parts(spark, str(tmp_path / "out"), (3,), space).collect(), 4) == found
            spark.conf.unset("spark.sql.files.maxPartitionBytes")

            nodes = ranked_nodes_of(read_ranked(spark, str(tmp_path / "out")))
            want = {r.id: (r.out_degree, r["rank"]) for r in result.ranked_nodes.collect()}
            got = {r.id: (r.out_degree, r["rank"]) for r in nodes.collect()}
            assert got == {k: (d, pytest.approx(v, abs=1e-15)) for k, (d, v) in want.items()}
            assert metrics.rank_total(nodes).first().total_rank == pytest.approx(1.0, abs=1e-12)
            assert len({r.id for r in ranking.top_k(nodes, 10).collect()}) == 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_parts_of_a_foreign_file(spark, tmp_path):
    """Files by name, blank and wrong lines between them, repeated ids apart from each other."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.txt").write_text("x\t3,4\n\ny\t1\nx\t5\n")
    (tmp_path / "in" / "a.txt").write_text("x\t1,2\nbroken\nz\t\n")
    rows = [(r.id, r.part, r.neighbors) for r in read_parts(spark, str(tmp_path / "in"), (2,)).collect()]
    assert sorted(rows) == [("x", 0, ["1", "2"]), ("x", 1, ["3", "4"]), ("x", 2, ["5"]), ("y", 0, ["1"]), ("z", 0, [])]


def test_parts_that_disagree_about_their_rank(spark):
    records = parse_ranked(spark.createDataFrame([("a\t0.5\tb",), ("a\t0.25\tc",)], "value string"))[0]
    with pytest.raises(Exception, match="more than one rank for node a"):
        ranked_nodes_of(records).collect()


def test_ranked_files_are_checked_as_they_are(spark, tmp_path):
    pairs = hub_pairs()
    with Workspace(spark) as space:
        graph = prepare(edge_frame(spark, pairs), workspace=space, names=True)
        result = rank(graph, tol=None, max_iter=3, keep_history=True)
        for i in (2, 3):
            write_ranked(result.snapshot(i), graph.adjacency_lists(4).drop("key"), str(tmp_path / f"iter{i}"), space)
        found = check_ranked_files(spark, str(tmp_path / "iter3"), str(tmp_path / "iter2"), workspace=space).first()
        row = result.history_rows[2]
        assert found.nodes == graph.n
        assert (found.total_rank, found.dangling_mass, found.max_delta, found.avg_delta, found.l1_delta) == pytest.approx(row[1:6], abs=1e-13)
        alone = check_ranked_files(spark, str(tmp_path / "iter3")).first()
        assert alone.max_delta is None and not alone.converged and alone.total_rank == found.total_rank


def test_every_iteration_is_written_with_its_lists(spark, tmp_path):
    (tmp_path / "edges.txt").write_text("\n".join(f"{a} {b}" for a, b in hub_pairs()))
    result = rank_files(spark, str(tmp_path / "edges.txt"), str(tmp_path / "out"), tol=None, max_iter=3, keep_history=True, list_limit=7)
    for i in (1, 2, 3):
        path = str(tmp_path / "out" / f"iter{i}")
        assert whole(read_parts(spark, path, (3,)).collect(), 7) == expected_lists(hub_pairs(), True)
        want = {r.id: r["rank"] for r in result.snapshot(i).collect()}
        assert {r.id: r["rank"] for r in ranked_nodes_of(read_ranked(spark, path)).collect()} == pytest.approx(want, abs=1e-15)
    result.close()


@pytest.mark.parametrize("source", ["edges", "adjacency", "ranked"])
def test_the_checked_lines_are_dropped_before_ranking(spark, tmp_path, monkeypatch, source):
    text = {"edges": "a b\nb a\nbad\nb c\n", "adjacency": "a\tb\nb\ta,c\nbad\nc\t\n", "ranked": "a\t0.4\tb\nb\t0.4\ta,c\nbad\nc\t0.2\t\n"}[source]
    (tmp_path / "in.txt").write_text(text)
    seen, real = [], files_module.rank

    def looked_at(graph, **options):
        seen.extend(r.tableName for r in spark.sql(f"SHOW TABLES IN {graph.workspace.database}").collect())
        return real(graph, **options)

    monkeypatch.setattr(files_module, "rank", looked_at)
    result = rank_files(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"), source=source, tol=None, max_iter=1)
    assert seen and not [t for t in seen if t.startswith(("checked", "records", "ids"))]
    assert [r.value for r in spark.read.parquet(str(tmp_path / "out" / "rejects")).collect()] == ["bad"]
    assert {r.id: r.neighbors for r in read_ranked(spark, str(tmp_path / "out" / "final")).collect()} == {"a": ["b"], "b": ["a", "c"], "c": []}
    result.close()


def test_rejects_are_read_without_the_edges(spark, workspace):
    from linkrank.sources import check_edges, split_checked

    lines = spark.createDataFrame([("a b",), ("bad",), ("c d e",)], "value string")
    edges, rejects = split_checked(workspace.save(check_edges(lines), "checked", apart="reason"))
    assert sorted(map(tuple, edges.collect())) == [("a", "b")] and edges.columns == ["src", "dst"]
    assert sorted(r.value for r in rejects.collect()) == ["bad", "c d e"] and rejects.columns == ["value", "reason"]
    for frame, filters in ((edges, "isnull(reason"), (rejects, "isnotnull(reason")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" + filters in plan


def test_records_of_a_node_keep_their_order_from_file_to_file(spark, tmp_path):
    (tmp_path / "in.txt").write_text("a\tx\na\tc\nb\t\na\tb\n")
    rank_files(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"), source="adjacency", tol=None, max_iter=1).close()
    rows = read_parts(spark, str(tmp_path / "out" / "final"), (3,)).orderBy("id", "part").collect()
    assert [(r.id, r.part, r.neighbors) for r in rows] == [("a", 0, ["x"]), ("a", 1, ["c"]), ("a", 2, ["b"]), ("b", 0, [])]
