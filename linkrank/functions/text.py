"""String handling built from native Spark expressions, so that it stays inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space, separators, and what counts as a whole or a decimal number.
WHITESPACE = " \t\n\x0b\f\r"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
NEIGHBOR_SEPARATOR = r"\s*,\s*"
DOUBLE_PATTERN = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"


def strip(value: Column) -> Column:
    """Remove white space at both ends; plain ``trim`` would leave tabs."""
    return F.trim(value, F.lit(WHITESPACE))


def parse_double(value: Column) -> Column:
    """A double, or NULL where the text is no number (``1d`` and ``0x1p3`` are none)."""
    text = strip(value)
    return F.when(text.rlike(DOUBLE_PATTERN), text.try_cast("double"))


def is_integer(value: Column) -> Column:
    return strip(value).rlike(INTEGER_PATTERN)


def integer_order(value: Column) -> Column:
    """Sort key that orders whole numbers of any length by value.

    Signed digit count first, then the digits; for negative numbers the digits are
    complemented, so that a larger magnitude sorts first. Nothing is cast, hence nothing overflows.
    """
    text = strip(value)
    digits = F.ltrim(F.regexp_replace(text, "^[+-]", ""), F.lit("0"))
    negative = text.startswith("-")
    return F.struct(
        F.when(negative, -F.length(digits)).otherwise(F.length(digits)).alias("size"),
        F.when(negative, F.translate(digits, "0123456789", "9876543210"))
        .otherwise(digits)
        .alias("digits"),
    )


def neighbor_list(value: Column) -> Column:
    """Comma separated ids as an array: each stripped, empty ones left out."""
    return F.array_remove(F.split(strip(value), NEIGHBOR_SEPARATOR, -1), "")


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A plain projection would be copied into every filter above it when Catalyst pushes those down,
    and an expensive split would run again for each mention. A generator is not copied.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
