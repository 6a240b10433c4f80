"""Adjacency and ranked records as text lines, one record per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.functions import fixed

# Separators of the record format; ids must not contain them.
FIELD_SEPARATOR = "\t"
LIST_SEPARATOR = ","
RESERVED = "[\t,\r\n]"


def _writable(value: Column) -> Column:
    """The id itself; the job fails on an id that could not be read back."""
    message = F.concat(F.lit("id contains a separator: "), value)
    return F.when(value.rlike(RESERVED), F.raise_error(message).cast("string")).otherwise(value)


def _joined(neighbors: Column) -> Column:
    return F.array_join(F.transform(neighbors, _writable), LIST_SEPARATOR)


def adjacency_lines(records: DataFrame) -> DataFrame:
    """``id <tab> neighbours``; the tab stays where there are none."""
    return records.select(
        F.concat_ws(FIELD_SEPARATOR, _writable(F.col("id")), _joined(F.col("neighbors"))).alias(
            "value"
        )
    )


def ranked_lines(records: DataFrame) -> DataFrame:
    """``id <tab> rank <tab> neighbours`` with 15 decimals."""
    return records.select(
        F.concat_ws(
            FIELD_SEPARATOR,
            _writable(F.col("id")),
            fixed(F.col("rank")),
            _joined(F.col("neighbors")),
        ).alias("value")
    )


def ranked_records(ranked_nodes: DataFrame, records: DataFrame) -> DataFrame:
    """``(id, part, rank, neighbors)``: ranks ``(id, rank)`` added to adjacency records ``(id, part, neighbors)``, of which a node may have several.

    Records meet their rank in an inner join, so that adaptive execution can split the many records of one node. A
    node without a record gets an empty list. Records without numbers are part 0.
    """
    first = F.lit(0).cast("long").alias("part")
    ranks = ranked_nodes.select("id", "rank")
    records = records.select("id", "part" if "part" in records.columns else first, "neighbors")
    found = records.join(ranks, "id").select("id", "part", "rank", "neighbors")
    bare = ranks.join(records.select("id"), "id", "left_anti")
    return found.unionByName(bare.select("id", first, "rank", F.array().cast("array<string>").alias("neighbors")))


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One file from each task, in the order of the tasks; lines of ordered records keep their order."""
    lines.select("value").write.mode(mode).text(path)


def write_history(snapshots: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Ranks of all iterations, one folder each."""
    snapshots.write.mode(mode).partitionBy("iteration").parquet(path)
