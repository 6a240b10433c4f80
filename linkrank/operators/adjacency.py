"""Adjacency records: building, ordering and flattening.

A record is ``(id, part, neighbors)``. Lists are bounded: the neighbours of a node, in their final order,
are cut after every ``list_limit`` of them, and each piece is a record with its number as ``part``. Most
nodes have one record, with part 0. The parts of a node one after the other give its whole list.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from linkrank.functions import integer_order, is_integer
from linkrank.operators.edges import out_degrees
from linkrank.plans.workspace import Workspace

LIST_LIMIT = 100_000
# Edges whose lists one task builds at a time.
EDGES_PER_TASK = 2_000_000


def adjacency_lists(
    edges: DataFrame,
    dedupe: bool = True,
    list_limit: int = LIST_LIMIT,
    workspace: Workspace | None = None,
    stage: bool = True,
) -> DataFrame:
    """``(id, part, neighbors)`` for every node of the graph, empty lists for dangling ones.

    With ``dedupe=False`` a neighbour is repeated as often as its edge is. Neighbours are ordered by value
    if all of a node's are whole numbers, else by text. The edges are read once and written as they come; ``stage=False`` reads them
    three times instead, for edges that are stored already. A first pass counts them by node, merged before the exchange. Then edges move once, to the
    task of their source, where copies are merged and lists are built, and cut if need be. Edges of sources with more than ``LIST_LIMIT``
    of them, and more than ``list_limit``, are merged by both ends instead, which spreads any hub, and their lists are numbered by ranges of their order.
    """
    if list_limit < 1:
        raise ValueError(f"list_limit must be greater than zero, not {list_limit}")
    workspace = workspace or Workspace(edges.sparkSession)
    edges = edges.select("src", "dst").dropna()
    if stage:
        edges = workspace.save(edges, workspace.new_name("pairs"))
    is_large = F.col("out_degree") > max(list_limit, LIST_LIMIT)
    totals = [F.count_if(is_large).alias("rows"), F.sum("out_degree").alias("edges")]
    counted = Observation()
    nodes = workspace.save(out_degrees(edges).observe(counted, *totals), workspace.new_name("counts"))
    some, n_edges = counted.get["rows"], counted.get["edges"] or 0
    large = nodes.where(is_large).select("id")
    linked = edges.select(F.col("src").alias("id"), F.col("dst").alias("neighbor"))
    copies = (F.lit(1).cast("long") if dedupe else F.count(F.lit(1))).alias("copies")

    small = linked.join(large, "id", "left_anti") if some else linked
    tasks = ceil(n_edges / EDGES_PER_TASK)
    spread = small.repartition(max(tasks, int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "id") if tasks > 1 else small.repartition("id")
    lists = spread.groupBy("id", "neighbor").agg(copies).groupBy("id").agg(order_neighbors(repeated_neighbors()).alias("neighbors"))
    whole = lists.unionByName(nodes.where("out_degree = 0").select("id", F.array().cast("array<string>").alias("neighbors")))
    whole = pieces_of(whole.select("id", F.lit(0).cast("long").alias("part"), "neighbors"), list_limit)
    if not some:
        return whole
    merged = linked.join(large, "id", "left_semi").groupBy("id", "neighbor").agg(copies)
    merged = workspace.save(merged, workspace.new_name("merged"))
    kinds = workspace.save(merged.groupBy("id").agg(F.bool_and(is_integer(F.col("neighbor"))).alias("numbers")), workspace.new_name("large"))
    return whole.unionByName(cut_lists(merged, kinds, list_limit, workspace))


def repeated_neighbors() -> Column:
    """All of ``neighbor`` in a group, each as often as ``copies`` says."""
    return F.flatten(F.collect_list(F.array_repeat("neighbor", F.col("copies").cast("int"))))


def pieces_of(lists: DataFrame, list_limit: int) -> DataFrame:
    """Whole lists ``(id, part, neighbors)`` of up to ``LIST_LIMIT`` as pieces of at most ``list_limit``, numbered from 0; each list is cut where it was built."""
    if list_limit >= LIST_LIMIT:
        return lists
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.size("neighbors") - 1) / list_limit), F.lit(0)).cast("int"))
    pieces = F.transform(starts, lambda k: F.slice("neighbors", k * list_limit + 1, list_limit))
    return lists.select("id", F.posexplode(pieces).alias("part", "neighbors")).select("id", F.col("part").cast("long").alias("part"), "neighbors")


def cut_lists(linked: DataFrame, large: DataFrame, list_limit: int, workspace: Workspace) -> DataFrame:
    """Parts of the lists of the nodes ``large(id, numbers)``, from ``linked(id, neighbor, copies)``. No task holds more than a range of one node's neighbours."""
    order = ["id", F.when(F.col("numbers"), integer_order(F.col("neighbor"))), "neighbor"]
    ranges = linked.join(large, "id").repartitionByRange(*order)
    stored = workspace.save(ranges.withColumn("slice", F.spark_partition_id()), workspace.new_name("ranges"))
    counts = stored.groupBy("id", "slice").agg(F.sum("copies").alias("rows"))
    # One row for each range that a node's neighbours reach into.
    earlier = Window.partitionBy("id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = workspace.save(
        counts.select("id", "slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset")),
        workspace.new_name("offsets"),
    )
    within = Window.partitionBy("id", "slice").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("copies").over(within), F.lit(0))
    placed = stored.join(offsets, ["id", "slice"]).withColumn("start", start)
    last = F.col("start") + F.col("copies") - 1
    parts = F.sequence(F.floor(F.col("start") / list_limit), F.floor(last / list_limit))
    pieces = placed.select("*", last.alias("last"), F.explode(parts).alias("part"))
    inside = F.least(F.col("last"), (F.col("part") + 1) * list_limit - 1) - F.greatest(F.col("start"), F.col("part") * list_limit) + 1
    lists = pieces.groupBy("id", "part").agg(
        F.array_sort(F.collect_list(F.struct("start", "neighbor", inside.cast("int").alias("times")))).alias("runs")
    )
    repeated = F.transform("runs", lambda x: F.array_repeat(x["neighbor"], x["times"]))
    return lists.select("id", "part", F.flatten(repeated).alias("neighbors"))


def order_neighbors(neighbors: Column) -> Column:
    """By value if every id of the list is a whole number, else by text."""
    by_value = F.transform(
        F.sort_array(
            F.transform(
                neighbors, lambda x: F.struct(integer_order(x).alias("order"), x.alias("id"))
            )
        ),
        lambda x: x["id"],
    )
    return F.when(F.forall(neighbors, is_integer), by_value).otherwise(F.sort_array(neighbors))


def explode_adjacency(records: DataFrame) -> DataFrame:
    """Records back to ``edges(src, dst)``; nodes with empty lists give no row."""
    return records.select(F.col("id").alias("src"), F.explode("neighbors").alias("dst"))


def validate_unique(records: DataFrame) -> None:
    """Raise if an id has more than one record: which one would count is not defined."""
    repeated = records.groupBy("id").count().where("count > 1").select("id")
    example = repeated.first()
    if example is not None:
        raise ValueError(f"more than one record for node {example['id']!r}")
