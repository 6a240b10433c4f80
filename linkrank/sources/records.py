"""Node records: ``id <tab> neighbours`` and ``id <tab> rank <tab> neighbours``.

Neighbours are comma separated. An empty list after the last tab marks a node without out-links,
which is why files are read with ``spark.read.text``: the CSV reader would turn it into NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkrank.functions import neighbor_list, parse_double, strip, with_once
from linkrank.plans.workspace import Workspace

#: Where a line stands: number and name of its file, start of the block it was read in, place within that.
POSITION = ("file", "name", "block", "line")


def check_records(lines: DataFrame, widths: tuple[int, ...] = (2, 3), keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, rank, neighbors, value, reason)`` of every line that isn't blank, in one pass.

    ``widths`` are the allowed numbers of fields. Rejected lines have a reason and their text; others have neither. Columns of
    ``lines`` named in ``keep`` come first.
    """
    fields = F.split(F.rtrim(F.col("value"), F.lit("\r\n")), "\t", -1)
    parts = with_once(lines.select(*keep, "value").where(F.col("value").rlike(r"\S")), "parts", fields)
    width = F.size("parts")
    ranked = width == 3
    checked = parts.select(
        *keep,
        "value",
        strip(F.get("parts", F.lit(0))).alias("id"),
        F.when(ranked, parse_double(F.get("parts", F.lit(1)))).alias("rank"),
        neighbor_list(F.get("parts", width - 1)).alias("neighbors"),
        width.alias("width"),
    ).withColumn(
        "reason",
        F.when(~F.col("width").isin(*widths), "wrong field count")
        .when((F.col("width") == 3) & F.col("rank").isNull(), "invalid rank")
        .when(F.col("id") == "", "empty node id"),
    )
    return checked.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value"))).drop("width")


def _split(parsed: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    return (
        parsed.where(F.col("reason").isNull()).select(*columns),
        parsed.where(F.col("reason").isNotNull()).select("value", "reason"),
    )


def parse_adjacency(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two-field lines as ``records(id, neighbors)``, and the ``rejects(value, reason)``."""
    return _split(check_records(lines, (2,)), ["id", "neighbors"])


def parse_ranked(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Three-field lines as ``records(id, rank, neighbors)``, and the rejects."""
    return _split(check_records(lines, (3,)), ["id", "rank", "neighbors"])


def parse_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of either width; ``rank`` is NULL where the line has none."""
    return _split(check_records(lines, (2, 3)), ["id", "rank", "neighbors"])


def read_adjacency(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_adjacency(spark.read.text(path))[0]


def read_ranked(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Ranked records of a snapshot; a snapshot without a single valid one is an error."""
    records = parse_ranked(spark.read.text(path))[0]
    if records.isEmpty():
        raise ValueError(f"no valid ranked records in {path}")
    return records


def lines_in_order(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their ``POSITION``. Files of one run come by their number, others by name.

    A task reads its blocks one after the other and numbers what it reads, so within a block the numbers rise with the lines.
    """
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, r"^part-([0-9]{5,9})", 1)
    return spark.read.text(path).select(
        "value", F.when(number != "", number.cast("int")).otherwise(-1).alias("file"), name.alias("name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
    )


def number_parts(records: DataFrame, workspace: Workspace) -> DataFrame:
    """``part`` in place of the ``POSITION`` of stored records: each id's records are numbered from 0 in the order of their lines.

    Only ids and positions are moved for it. Where an id has one record that is part 0; the others get their numbers by
    position, which spreads the records of any one node.
    """
    own = Window.partitionBy("id").orderBy(*POSITION)
    places = records.select("id", *POSITION).withColumn("part", F.row_number().over(own).cast("long") - 1)
    later = workspace.save(places.where("part > 0").drop("id"), workspace.new_name("places"))
    part = F.coalesce("part", F.lit(0).cast("long")).alias("part")
    rest = [c for c in records.columns if c not in ("id", *POSITION)]
    return records.join(later, list(POSITION), "left").select("id", part, *rest)


def read_parts(spark: SparkSession, path: str | list[str], widths: tuple[int, ...] = (2, 3), workspace: Workspace | None = None) -> DataFrame:
    """``(id, part, rank, neighbors)`` of the records in ``path``: the parts of a node one after the other are its whole list."""
    workspace = workspace or Workspace(spark)
    checked = check_records(lines_in_order(spark, path), widths, POSITION).where(F.col("reason").isNull())
    return number_parts(workspace.save(checked.drop("value", "reason"), workspace.new_name("records")), workspace)


def ranked_nodes_of(records: DataFrame) -> DataFrame:
    """``(id, out_degree, rank)``, one row a node, of ranked records in parts, each of which repeats the rank of its node.

    Parts are merged before the exchange. The job fails on a node whose parts disagree about its rank.
    """
    ranks = records.groupBy("id").agg(F.sum(F.size("neighbors")).alias("out_degree"), F.min("rank").alias("rank"), F.max("rank").alias("highest"))
    message = F.concat(F.lit("more than one rank for node "), F.col("id"))
    return ranks.select("id", "out_degree", F.when(F.col("rank") == F.col("highest"), F.col("rank")).otherwise(F.raise_error(message).cast("double")).alias("rank"))
