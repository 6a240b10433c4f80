"""What one task holds doesn't grow with the table: more rows give more tasks, and the same results."""

import pytest
from conftest import edge_frame
from pyspark.sql import functions as F

from linkrank import Workspace, prepare, rank
from linkrank.operators import adjacency, edges
from linkrank.plans import graph as graph_module
from queries import graphs

PAIRS = [(f"P{i % 37}", f"S{i * i % 23}") for i in range(400)] + [(f"S{i}", "P1") for i in range(5)]


def rows(df):
    return sorted(map(tuple, df.collect()))


def partitions(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_merge_tasks_are_a_multiple_of_the_buckets():
    limit = graph_module.EDGES_PER_TASK
    assert graph_module.merge_tasks(12, 0) == 12
    assert graph_module.merge_tasks(12, 12 * limit) == 12
    assert graph_module.merge_tasks(14, 432_000_000) % 14 == 0
    assert 432_000_000 / graph_module.merge_tasks(14, 432_000_000) <= limit


@pytest.mark.parametrize("dedupe", [True, False])
def test_links_merged_by_several_tasks_a_bucket(spark, dedupe, monkeypatch):
    expected = prepare(edge_frame(spark, PAIRS), dedupe=dedupe)
    monkeypatch.setattr(graph_module, "EDGES_PER_PARTITION_SMALL", 200)
    monkeypatch.setattr(graph_module, "EDGES_PER_TASK", 30)
    found = prepare(edge_frame(spark, PAIRS), dedupe=dedupe)
    assert found.partitions == 3
    files = spark.read.parquet(f"{found.workspace.location}/{found.tables['links']}").select(F.input_file_name()).distinct().count()
    assert files > found.partitions
    assert rows(found.links.light) == rows(expected.links.light)
    results = [rows(rank(g, tol=None, max_iter=4).ranks) for g in (found, expected)]
    assert results[0] == results[1]
    found.workspace.close(), expected.workspace.close()


@pytest.mark.parametrize("dedupe", [True, False])
def test_lists_are_built_in_many_tasks(spark, dedupe, monkeypatch):
    whole = rows(adjacency.adjacency_lists(edge_frame(spark, PAIRS), dedupe=dedupe))
    assert partitions(adjacency.adjacency_lists(edge_frame(spark, PAIRS), dedupe=dedupe).where("size(neighbors) > 0")) <= 4
    monkeypatch.setattr(adjacency, "EDGES_PER_TASK", 30)
    lists = adjacency.adjacency_lists(edge_frame(spark, PAIRS), dedupe=dedupe)
    assert partitions(lists.where("size(neighbors) > 0")) > 4
    assert rows(lists) == whole


def test_short_lists_are_cut_where_they_are_built(spark):
    """No table of ranges is written for nodes whose whole list one task may hold, and the pieces are those of the whole lists."""
    with Workspace(spark) as space:
        pieces = adjacency.adjacency_lists(edge_frame(spark, PAIRS), False, 3, space).collect()
        whole = {r["id"]: r["neighbors"] for r in adjacency.adjacency_lists(edge_frame(spark, PAIRS), False).collect()}
        graph = prepare(edge_frame(spark, PAIRS), dedupe=False, names=True, workspace=space)
        of_graph = graph.adjacency_lists(3).drop("key")
        assert rows(of_graph) == sorted(map(tuple, pieces))
        names = [t.name for t in spark.catalog.listTables(f"spark_catalog.{space.database}")]
        assert not [n for n in names if n.startswith(("ranges", "offsets", "merged"))]
    found = {}
    for r in sorted(pieces, key=lambda r: (r["id"], r["part"])):
        assert len(r["neighbors"]) <= 3 and r["part"] == len(found.get(r["id"], [])) / 3
        found.setdefault(r["id"], []).extend(r["neighbors"])
    assert found == whole


def test_lists_past_the_limit_of_a_task_go_by_ranges(spark, monkeypatch):
    expected = rows(adjacency.adjacency_lists(edge_frame(spark, PAIRS), False, 3))
    of_graph = prepare(edge_frame(spark, PAIRS), dedupe=False, names=True)
    monkeypatch.setattr(adjacency, "LIST_LIMIT", 7)
    monkeypatch.setattr(graph_module, "LIST_LIMIT", 7)
    assert rows(adjacency.adjacency_lists(edge_frame(spark, PAIRS), False, 3)) == expected
    assert rows(of_graph.adjacency_lists(3).drop("key")) == expected
    of_graph.workspace.close()


def test_node_set_computes_its_edges_once(spark):
    frame = edge_frame(spark, [("a", "b"), ("b", None), (None, "a"), ("c", "c")])
    found = edges.node_set(frame)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "id string").collect()))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_join_of_the_trade_graph_has_a_task_for_so_many_rows(spark, tmp_path, monkeypatch):
    tables = {
        "lineitem": ([(i % 90 if i % 11 else None, i % 7, i % 5) for i in range(300)], "l_orderkey long, l_partkey long, l_suppkey long"),
        "orders": ([(i % 80, i % 9) for i in range(100)] + [(None, 1)], "o_orderkey long, o_custkey long"),
        "supplier": ([(i, i % 2) for i in range(5)], "s_suppkey long, s_nationkey int"),
        "customer": ([(i, i % 2) for i in range(9)], "c_custkey long, c_nationkey int"),
        "nation": ([(0, 0), (1, 0)], "n_nationkey int, n_regionkey int"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert graphs.join_tasks(graphs.table(spark, str(tmp_path), "lineitem")) == 0
    expected = sorted(map(repr, graphs.trade(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(graphs, "ROWS_PER_TASK", 20)
    assert graphs.join_tasks(graphs.table(spark, str(tmp_path), "lineitem")) == 15
    assert sorted(map(repr, graphs.trade(spark, str(tmp_path)).collect())) == expected
