"""The kept iterations of a run as one table on disk, in which a node's rows of all iterations lie in one bucket."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.plans.iterate import RankResult
from linkrank.plans.workspace import Workspace


def store_history(result: RankResult, path: str) -> None:
    """``(iteration, key, id, out_degree, rank)`` of all kept iterations, a folder each, in the buckets of the graph.

    Every state is joined with its ids in the buckets it lies in and written to the same ones, so nothing is moved. ``key``
    stands for the id. The folders are plain Parquet for any reader; ``open_history`` also knows the buckets.
    """
    space, buckets = result.graph.workspace, result.graph.partitions
    for iteration in result.snapshot_tables:
        name = space.new_name("history")
        rows = result.keyed_snapshot(iteration).select("key", "id", "out_degree", "rank")
        writer = rows.write.format("parquet").bucketBy(buckets, "key").option("path", f"{path}/iteration={iteration}")
        writer.saveAsTable(space.table_name(name))
        space.forget(name)
    layout = space.spark.createDataFrame([(json.dumps({"key": "key", "buckets": buckets}),)], "value string")
    layout.coalesce(1).write.text(f"{path}/_layout")


def open_history(workspace: Workspace, path: str) -> DataFrame:
    """What ``store_history`` wrote, as a table that is known to be in buckets by ``key``: grouping by it needs no exchange."""
    spark = workspace.spark
    layout = json.loads(spark.read.text(f"{path}/_layout").first()["value"])
    name = workspace.new_name("history")
    columns = [f for f in spark.read.parquet(path).schema if f.name != "iteration"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    spark.sql(
        f"CREATE TABLE {workspace.table_name(name)} ({fields}, iteration INT) USING parquet PARTITIONED BY (iteration) "
        f"CLUSTERED BY (`{layout['key']}`) INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(workspace.table_name(name))
    return workspace.table(name).select("iteration", *(F.col(f.name) for f in columns))
