"""Turn edges or adjacency records into the tables an iterative run works on.

Ids are replaced by 8-byte hash keys once, by a column expression and not by a join, so that the
iterations never move long strings. The keys are checked for collisions; if there are any, longer keys are
used, and in the end the ids themselves.

Passes over the data, each written to the workspace:

1. ``edges``: the input once, so that parsing or extraction upstream is not repeated (``stage=True``);
2. ``ids``: every id with its number of outgoing rows, in one aggregation;
3. ``links``: edges by key, moved once to the bucket of their source, merged and sorted there;
4. ``nodes``: key, id and out-degree, in the same buckets.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkrank.functions import is_integer
from linkrank.operators.adjacency import LIST_LIMIT, cut_lists, explode_adjacency, order_neighbors, pieces_of, repeated_neighbors, validate_unique
from linkrank.operators.skew import (
    HEAVY_ROWS,
    MAX_HEAVY,
    heavy_limit,
    split_by_source,
)
from linkrank.operators.step import Links
from linkrank.plans.workspace import Workspace, shuffle_partitions

# Partition sizes: small graphs get few partitions, large ones stay within a task's memory.
EDGES_PER_PARTITION_SMALL = 50_000
EDGES_PER_PARTITION = 32_000_000
# Edges that one task merges and sorts at a time; several tasks then write to one bucket.
EDGES_PER_TASK = 2_000_000
NODES_PER_PARTITION = 2_000_000
# Fixed value: Spark's default for spark.sql.sources.bucketing.maxBuckets.
MAX_BUCKETS = 100_000


def short_key(id_: Column) -> Column:
    return F.xxhash64(id_)


def long_key(id_: Column) -> Column:
    return F.unhex(F.md5(id_))


def id_key(id_: Column) -> Column:
    return id_


KEYS: tuple[Callable[[Column], Column], ...] = (short_key, long_key, id_key)


@dataclass(frozen=True)
class Graph:
    """A prepared graph. ``nodes`` has ``(key, id, out_degree, member)``; ``n`` counts the members.

    Rows that are no members are link targets without a node record of their own.
    """

    workspace: Workspace
    nodes: DataFrame
    links: Links
    n: int
    n_edges: int
    n_dangling: int
    partitions: int
    key: Callable[[Column], Column]
    #: Names of the tables in the workspace, and the seconds that preparation took.
    tables: dict[str, str]
    seconds: float = 0.0
    #: Whether the stored links have the ids of their targets, from which lists can be built.
    names: bool = False

    @property
    def spark(self) -> SparkSession:
        return self.workspace.spark

    def members(self) -> DataFrame:
        """``(id, out_degree)`` of the nodes."""
        return self.nodes.where("member").select("id", "out_degree")

    def start_state(self) -> DataFrame:
        """Every node with rank ``1/N``, by key."""
        return self.nodes.where("member").select(
            F.col("key").alias("id"), "out_degree", F.lit(1.0 / self.n).alias("rank")
        )

    def stats(self) -> DataFrame:
        """Nodes, edges and dangling nodes in one row."""
        return self.nodes.where("member").agg(
            F.count(F.lit(1)).alias("nodes"),
            F.sum("out_degree").alias("edges"),
            F.count_if(F.col("out_degree") == 0).alias("dangling"),
        )


    def adjacency_lists(self, list_limit: int = LIST_LIMIT) -> DataFrame:
        """``(key, id, part, neighbors)`` of the members: the neighbours in their order, cut after every ``list_limit`` of them.

        The stored links are grouped in their buckets and meet their node there, so no edge is moved but those of nodes past
        the limit. The graph must have been prepared with ``names=True``.
        """
        if not self.names:
            raise ValueError("the links have no names; prepare the graph with names=True")
        if list_limit < 1:
            raise ValueError(f"list_limit must be greater than zero, not {list_limit}")
        columns = [F.col("src").alias("id"), F.col("dst_id").alias("neighbor"), F.lit(1).cast("long").alias("copies") if "once" in self.tables else "copies"]
        light = self.workspace.table(self.tables["links"]).select(*columns)
        heavy = self.workspace.table(self.tables["heavy_links"]).select(*columns) if "heavy_links" in self.tables else None
        # A list of up to LIST_LIMIT is built in one task, and cut there if need be.
        large = self.nodes.where(F.col("out_degree") > max(list_limit, LIST_LIMIT)).select(F.col("key").alias("id"))
        cut = not large.isEmpty()
        first = F.lit(0).cast("long").alias("part")

        def whole(links: DataFrame) -> DataFrame:
            rest = links.join(bounded_hash(large, self.partitions), "id", "left_anti") if cut else links
            return rest.groupBy("id").agg(order_neighbors(repeated_neighbors()).alias("neighbors")).select("id", first, "neighbors")

        lists = whole(light) if heavy is None else whole(light).unionByName(whole(heavy))
        lists = pieces_of(lists, list_limit)
        if cut:
            linked = light if heavy is None else light.unionByName(heavy)
            of_large = linked.join(large, "id")
            kinds = of_large.groupBy("id").agg(F.bool_and(is_integer(F.col("neighbor"))).alias("numbers"))
            kinds = self.workspace.save(kinds, self.workspace.new_name("large"))
            lists = lists.unionByName(cut_lists(linked, kinds, list_limit, self.workspace))
        members = self.nodes.where("member")
        found = lists.withColumnRenamed("id", "of").join(bounded_hash(members.select("key", "id"), self.partitions), F.col("of") == F.col("key"))
        none = F.array().cast("array<string>").alias("neighbors")
        return found.select("key", "id", "part", "neighbors").unionByName(members.where("out_degree = 0").select("key", "id", first, none))

    def without_copies(self) -> Graph:
        """The same graph with each edge once. Degrees are counted anew in their buckets; nothing else is prepared again."""
        began = time.perf_counter()
        once = F.lit(1).cast("long").alias("copies")
        heavy = self.links.heavy
        links = Links(self.links.light.select("src", "dst", once), None if heavy is None else heavy.select("src", "dst", once), self.links.heavy_sources, self.links.bucketed)
        ids = self.nodes.select("key", "id", "member")
        name, counted = self.workspace.new_name("nodes"), Observation()
        with shuffle_partitions(self.spark, self.partitions):
            nodes = self.workspace.save(_with_degrees(ids, links, True, self.partitions).observe(counted, *_totals()), name, "key", self.partitions)
        totals = counted.get
        return replace(self, nodes=nodes, links=links, n_edges=totals["edges"], n_dangling=totals["dangling"], tables=self.tables | {"nodes": name, "once": "yes"}, seconds=self.seconds + time.perf_counter() - began)

    def describe(self) -> dict:
        """What ``reopen_graph`` needs to find the graph again in its workspace."""
        return {
            "n": self.n, "n_edges": self.n_edges, "n_dangling": self.n_dangling, "partitions": self.partitions,
            "key": KEYS.index(self.key), "tables": self.tables, "seconds": self.seconds, "names": self.names,
        }


def reopen_graph(workspace: Workspace, described: dict) -> Graph:
    """A graph from the tables that an earlier session left in a named workspace."""
    tables, buckets = described["tables"], described["partitions"]
    light = workspace.attach(tables["links"], "src", buckets, ordered=True).select("src", "dst", "copies")
    heavy = workspace.attach(tables["heavy_links"]).select("src", "dst", "copies") if "heavy_links" in tables else None
    sources = workspace.attach(tables["heavy_ids"]).select(F.col("key").alias("src")) if heavy is not None else None
    if "once" in tables:
        once = F.lit(1).cast("long").alias("copies")
        light, heavy = light.select("src", "dst", once), None if heavy is None else heavy.select("src", "dst", once)
    nodes = workspace.attach(tables["nodes"], "key", buckets)
    return Graph(workspace, nodes, Links(light, heavy, sources, buckets < MAX_BUCKETS), described["n"], described["n_edges"], described["n_dangling"], buckets, KEYS[described["key"]], tables, described["seconds"], described["names"])


def _totals() -> list[Column]:
    return [
        F.sum(F.when(F.col("member"), F.col("out_degree"))).alias("edges"),
        F.count_if(F.col("member") & (F.col("out_degree") == 0)).alias("dangling"),
    ]


def partition_count(default: int, n_edges: int, n_nodes: int) -> int:
    """Buckets for a graph of this size; they grow with it beyond the session's ``default``."""
    wanted = max(
        1,
        min(default, ceil(n_edges / EDGES_PER_PARTITION_SMALL)),
        ceil(n_edges / EDGES_PER_PARTITION),
        ceil(n_nodes / NODES_PER_PARTITION),
    )
    return min(wanted, MAX_BUCKETS)


def merge_tasks(buckets: int, n_edges: int) -> int:
    """Tasks that merge and sort the edges: so many for each bucket that a task's share does not grow with the graph."""
    return buckets * max(1, ceil(n_edges / (buckets * EDGES_PER_TASK)))


def bounded_hash(df: DataFrame, buckets: int) -> DataFrame:
    """Ask for a hash join as long as the buckets keep one side within a task's memory; past their highest number, don't."""
    return df.hint("shuffle_hash") if buckets < MAX_BUCKETS else df


def prepare(
    edges: DataFrame,
    nodes: DataFrame | None = None,
    dedupe: bool = True,
    workspace: Workspace | None = None,
    stage: bool = False,
    heavy_rows: int = HEAVY_ROWS,
    max_heavy: int = MAX_HEAVY,
    names: bool = False,
) -> Graph:
    """Prepare ``edges(src, dst)`` for ranking; rows that lack either id are no edges.

    ``dedupe=False`` keeps copies of an edge, each of which carries a share of its own. ``nodes(id)``
    names the nodes; without it every id of an edge is a node. The edges are read twice; ``stage=True``
    writes them first, for edges that are costly to compute. A workspace may hold several graphs. ``names=True`` stores the id
    of its target with each link, in a column that the iterations don't read, for ``Graph.adjacency_lists``.
    """
    began = time.perf_counter()
    spark = edges.sparkSession
    owned = workspace is None
    workspace = workspace or Workspace(spark)
    tables = {name: workspace.new_name(name) for name in ("edges", "ids", "heavy_ids", "links", "heavy_links", "nodes")}
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged, expected = edges.select("src", "dst").dropna(), 0
    if stage:
        arrived = Observation()
        staged = workspace.save(
            staged.observe(arrived, F.count(F.lit(1)).alias("rows")), tables["edges"]
        )
        expected = arrived.get["rows"]

    with shuffle_partitions(spark, max(default, ceil(expected / EDGES_PER_PARTITION))):
        ids, key, seen = _identify(workspace, staged, nodes, tables["ids"])
    if not seen["members"]:
        if owned:
            workspace.close()
        raise ValueError("the graph has no nodes")
    n_raw = seen["links"] or 0
    limit = heavy_limit(n_raw, heavy_rows, max_heavy)
    heavy = None
    if (seen["largest"] or 0) > limit:
        # Fewer than max_heavy rows, since each stands for more than one max_heavy-th of all edges.
        heavy = workspace.save(
            ids.where(F.col("links") > limit).select(F.col("id").alias("src"), "key"), tables["heavy_ids"]
        )

    buckets = partition_count(default, n_raw, seen["ids"])
    with shuffle_partitions(spark, buckets):
        links = _store_links(workspace, staged, heavy, key, dedupe, buckets, merge_tasks(buckets, n_raw), tables, names)
        counted = Observation()
        stored = workspace.save(
            _with_degrees(ids, links, dedupe, buckets).observe(counted, *_totals()),
            tables["nodes"],
            "key",
            buckets,
        )
    totals = counted.get
    for name in ("ids", "edges"):
        workspace.drop(tables.pop(name))
    if heavy is None:
        tables = {name: tables[name] for name in ("links", "nodes")}
    return Graph(
        workspace=workspace,
        nodes=stored,
        links=links,
        n=seen["members"],
        n_edges=totals["edges"],
        n_dangling=totals["dangling"],
        partitions=buckets,
        key=key,
        tables=tables,
        seconds=time.perf_counter() - began,
        names=names,
    )


def prepare_records(
    records: DataFrame,
    workspace: Workspace | None = None,
    stage: bool = False,
    unique: bool = False,
    **options: int | bool,
) -> Graph:
    """Prepare adjacency records ``(id, neighbors)``; each id is a node, linked or not.

    Several records of an id are parts of its list; ``unique=True`` refuses them. Repeated neighbours count as
    often as they are listed. ``stage=True`` writes the records first, for records that are costly to compute.
    """
    began = time.perf_counter()
    workspace = workspace or Workspace(records.sparkSession)
    kept, copy = records.select("id", "neighbors"), workspace.new_name("records")
    if stage:
        # One copy serves ids and edges, in place of one of the edges alone.
        kept = workspace.save(kept, copy)
    if unique:
        validate_unique(kept.select("id"))
    graph = prepare(explode_adjacency(kept), kept.select("id"), False, workspace, **options)
    workspace.drop(copy)
    return replace(graph, seconds=time.perf_counter() - began)


def _identify(
    workspace: Workspace, edges: DataFrame, nodes: DataFrame | None, name: str
) -> tuple[DataFrame, Callable[[Column], Column], dict[str, int]]:
    """Table ``ids(id, key, links, member)``, the key in use, and its totals."""
    known = F.lit(nodes is None).alias("member")
    rows = edges.select(F.col("src").alias("id"), F.lit(1).alias("links"), known).union(
        edges.select(F.col("dst").alias("id"), F.lit(0).alias("links"), known)
    )
    if nodes is not None:
        rows = rows.union(nodes.select("id", F.lit(0).alias("links"), F.lit(True).alias("member")))
    distinct = rows.groupBy("id").agg(
        F.sum("links").alias("links"), F.bool_or("member").alias("member")
    )

    for key in KEYS:
        totals = Observation()
        workspace.drop(name)
        ids = workspace.save(
            distinct.withColumn("key", key(F.col("id"))).observe(
                totals,
                F.count(F.lit(1)).alias("ids"),
                F.count_if("member").alias("members"),
                F.sum("links").alias("links"),
                F.max("links").alias("largest"),
            ),
            name,
        )
        if key is id_key or ids.groupBy("key").count().where("count > 1").isEmpty():
            return ids, key, totals.get
    raise AssertionError("the id itself is always a unique key")


def _store_links(
    workspace: Workspace,
    edges: DataFrame,
    heavy: DataFrame | None,
    key: Callable[[Column], Column],
    dedupe: bool,
    buckets: int,
    tasks: int,
    tables: dict[str, str],
    names: bool,
) -> Links:
    copies = F.lit(1).cast("long") if dedupe else F.count(F.lit(1))
    keyed = [key(F.col("src")).alias("src"), key(F.col("dst")).alias("dst")]
    columns = ["src", "dst", "copies"]
    if names:
        # One key stands for one id, so the groups stay the same.
        keyed, columns = [*keyed, F.col("dst").alias("dst_id")], [*columns, "dst_id"]
    groups = [c for c in columns if c != "copies"]
    light, large = split_by_source(edges, heavy)

    # Partitioning by source alone also serves the merging of copies and the buckets: one exchange. As the number of tasks is a multiple
    # of that of the buckets, the sources of a task are all of one bucket.
    merged = (
        light.select(*keyed)
        .repartition(tasks, "src")
        .groupBy(*groups)
        .agg(copies.alias("copies"))
        .select(*columns)
    )
    stored = workspace.save(merged, tables["links"], "src", buckets, ordered=True).select("src", "dst", "copies")
    if large is None:
        return Links(stored, bucketed=buckets < MAX_BUCKETS)
    # Edges of heavy sources are spread by both ends, after copies were merged on the map side.
    spread = large.select(*keyed).groupBy(*groups).agg(copies.alias("copies")).select(*columns)
    return Links(
        stored,
        workspace.save(spread, tables["heavy_links"]).select("src", "dst", "copies"),
        heavy.select(F.col("key").alias("src")),
        bucketed=buckets < MAX_BUCKETS,
    )


def _with_degrees(ids: DataFrame, links: Links, dedupe: bool, buckets: int) -> DataFrame:
    columns = ["key", "id", "out_degree", "member"]
    if not dedupe:
        return ids.withColumnRenamed("links", "out_degree").select(*columns).repartition(
            buckets, "key"
        )
    degrees = links.light.groupBy("src").agg(F.sum("copies").alias("out_degree"))
    if links.heavy is not None:
        degrees = degrees.union(
            links.heavy.groupBy("src").agg(F.sum("copies").alias("out_degree"))
        )
    return ids.join(bounded_hash(degrees, buckets), F.col("key") == F.col("src"), "left").select(
        "key", "id", F.coalesce("out_degree", F.lit(0).cast("long")).alias("out_degree"), "member"
    )
