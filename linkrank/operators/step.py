"""One ranking iteration.

``links`` hold ``(src, dst, copies)``; the state holds ``(id, out_degree, rank)``. Ids may be of any
type: the loop runs these operators on compact keys, single steps run on plain strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.functions.sums import small_sum, steady_sum, unit_for
from linkrank.operators.edges import count_copies, dedupe_edges
from linkrank.operators.skew import (
    HEAVY_ROWS,
    MAX_HEAVY,
    heavy_sources,
    split_by_source,
)

UNKNOWN_TARGETS = ("drop", "materialize")


@dataclass(frozen=True)
class Links:
    """Edges ready for joining with ranks.

    ``light`` are the edges of ordinary sources, ``heavy`` those of the few sources that are too
    large for one task, ``heavy_sources`` the ids of the latter. ``bucketed`` tells that ``light`` is
    stored by source in partitions small enough for a hash join.
    """

    light: DataFrame
    heavy: DataFrame | None = None
    heavy_sources: DataFrame | None = None
    bucketed: bool = False


def make_links(
    edges: DataFrame,
    dedupe: bool = True,
    heavy_rows: int = HEAVY_ROWS,
    max_heavy: int = MAX_HEAVY,
    unique: bool = False,
) -> Links:
    """Links straight from ``edges(src, dst)``, without writing tables; for single steps.

    ``unique`` tells that no edge comes twice, so that none need be looked for.
    """
    heavy = heavy_sources(edges, heavy_rows, max_heavy)
    if unique:
        counted = edges.select("src", "dst", F.lit(1).cast("long").alias("copies"))
    elif dedupe:
        counted = dedupe_edges(edges).withColumn("copies", F.lit(1).cast("long"))
    else:
        counted = count_copies(edges)
    light, heavy_edges = split_by_source(counted, heavy)
    return Links(light, heavy_edges, None if heavy is None else heavy.select("src"))


def contributions(links: Links, state: DataFrame) -> DataFrame:
    """``(src, dst, amount)``: each node hands its rank to its targets in equal shares.

    Ordinary sources meet their edges in an equality join. For heavy sources the join is turned
    round: their few shares are broadcast and their edges stay where they are.
    """
    shares = state.where("out_degree > 0").selectExpr("id AS src", "rank / out_degree AS share")
    columns = ["src", "dst", "copies * share AS amount"]
    near = shares.hint("shuffle_hash") if links.bucketed else shares
    result = links.light.join(near, "src").selectExpr(*columns)
    if links.heavy is not None:
        few = shares.join(F.broadcast(links.heavy_sources), "src", "left_semi")
        result = result.union(
            links.heavy.join(F.broadcast(few), "src").selectExpr(*columns)
        )
    return result


def incoming_sums(amounts: DataFrame, total: float | None = None) -> DataFrame:
    """Total received per target, the same bits in whatever order and parts the amounts come.

    Sums are formed before the shuffle, so popular targets do no harm. ``total`` is a bound on all amounts together where
    one is known, which makes the sums cheaper.
    """
    amount = F.col("amount")
    received = steady_sum(amount) if total is None else small_sum(amount, unit_for(total))
    return amounts.groupBy("dst").agg(received.alias("incoming"))


def join_incoming(
    state: DataFrame, sums: DataFrame, unknown_targets: str = "drop", bucketed: bool = False
) -> DataFrame:
    """``(id, out_degree, rank, incoming)`` for every node, 0.0 where nothing came in.

    Targets that are no nodes vanish with ``"drop"``; with ``"materialize"`` they become nodes without
    out-links, whose rank so far is 0.
    """
    if unknown_targets not in UNKNOWN_TARGETS:
        raise ValueError(f"unknown_targets must be one of {UNKNOWN_TARGETS}, not {unknown_targets!r}")
    received = sums.hint("shuffle_hash") if bucketed else sums
    if unknown_targets == "drop":
        joined = state.join(received, F.col("id") == F.col("dst"), "left")
    else:
        joined = state.join(received, F.col("id") == F.col("dst"), "full_outer")
    return joined.selectExpr(
        "coalesce(id, dst) AS id",
        "coalesce(out_degree, 0L) AS out_degree",
        "coalesce(rank, 0D) AS rank",
        "coalesce(incoming, 0D) AS incoming",
    )


def updated_rank(incoming: Column, n: int, dangling: float, damping: float) -> Column:
    """``(1 - d)/N + d * (incoming + dangling/N)``."""
    return F.lit((1.0 - damping) / n) + F.lit(damping) * (incoming + F.lit(dangling / n))


def rank_step(
    links: Links,
    state: DataFrame,
    n: int,
    dangling: float,
    damping: float = 0.85,
    unknown_targets: str = "drop",
    total: float | None = None,
) -> DataFrame:
    """The next state ``(id, out_degree, rank)``, together with ``previous_rank``.

    ``dangling`` is the rank held by nodes without out-links in ``state``, that is before this step, and ``total`` a bound on
    all of its rank, if one is known.
    """
    check_step_arguments(n, dangling, damping)
    sums = incoming_sums(contributions(links, state), total)
    joined = join_incoming(state, sums, unknown_targets, links.bucketed)
    return joined.select(
        "id",
        "out_degree",
        updated_rank(F.col("incoming"), n, dangling, damping).alias("rank"),
        F.col("rank").alias("previous_rank"),
    )


def check_step_arguments(n: int, dangling: float, damping: float) -> None:
    if n <= 0:
        raise ValueError("the graph has no nodes")
    if not 0.0 < damping < 1.0:
        raise ValueError(f"damping must lie between 0 and 1, not {damping}")
    if dangling < 0.0:
        raise ValueError(f"dangling mass cannot be negative: {dangling}")
