"""Edge lists: one ``source target`` pair per line.

The parsers take a DataFrame with a string column ``value`` (what ``spark.read.text`` gives), so
they work on files, directories and derived lines alike, and are a map-only stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.functions import strip, with_once

SEPARATORS = ("whitespace", "tab")
FIELD_RULES = ("exact", "at_least")


def check_edges(
    lines: DataFrame,
    sep: str = "whitespace",
    fields: str = "exact",
    comment: str | None = "#",
) -> DataFrame:
    """``(src, dst, value, reason)`` of every line that is neither blank nor a comment, in one pass.

    ``fields="exact"`` wants two fields, ``"at_least"`` ignores further ones. Ids stay strings. Rejected
    lines have a reason and their text; others have neither.
    """
    if sep not in SEPARATORS:
        raise ValueError(f"sep must be one of {SEPARATORS}, not {sep!r}")
    if fields not in FIELD_RULES:
        raise ValueError(f"fields must be one of {FIELD_RULES}, not {fields!r}")

    if comment == "":
        raise ValueError("every line starts with the empty prefix; use comment=None for no comments")

    value = F.col("value")
    if sep == "whitespace":
        tokens = F.array_remove(F.split(value, r"\s+", -1), "")
    else:
        tokens = F.split(strip(value), "\t", -1)
    first, second = (F.get("tokens", F.lit(i)) for i in (0, 1))
    if sep == "tab":
        first, second = strip(first), strip(second)

    read = with_once(lines.select("value"), "tokens", tokens)
    kept = read.where((F.size("tokens") > 1) | (first != ""))
    if comment is not None:
        kept = kept.where(~first.startswith(comment))
    count = F.size("tokens")
    wrong_count = (count != 2) if fields == "exact" else (count < 2)
    reason = F.when(wrong_count, "wrong field count").when((first == "") | (second == ""), "empty node id")
    checked = kept.select(first.alias("src"), second.alias("dst"), "value", reason.alias("reason"))
    return checked.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What was read, and the ``rejects(value, reason)``."""
    return (
        checked.where(F.col("reason").isNull()).drop("value", "reason"),
        checked.where(F.col("reason").isNotNull()).select("value", "reason"),
    )


def parse_edges(
    lines: DataFrame,
    sep: str = "whitespace",
    fields: str = "exact",
    comment: str | None = "#",
) -> tuple[DataFrame, DataFrame]:
    """Split lines into ``edges(src, dst)`` and ``rejects(value, reason)``; see ``check_edges``."""
    return split_checked(check_edges(lines, sep, fields, comment))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Number of rejected lines by reason."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def read_edges(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "whitespace",
    fields: str = "exact",
    comment: str | None = "#",
) -> DataFrame:
    """Edges of a file or of every file in a directory (names starting ``_`` or ``.`` are ignored).

    Rejected lines are left out; ``parse_edges`` gives them too.
    """
    return parse_edges(spark.read.text(path), sep, fields, comment)[0]
