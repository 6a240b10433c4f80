"""Number formats of the text reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of ranks and changes in reports.
FIXED_FORMAT = "%.15f"
SCIENTIFIC_FORMAT = "%.15e"


def fixed(value: Column) -> Column:
    return F.format_string(FIXED_FORMAT, value)


def scientific(value: Column) -> Column:
    """Exponent form; a missing value (no previous iteration) is written ``inf``."""
    return F.when(value.isNull(), F.lit("inf")).otherwise(
        F.format_string(SCIENTIFIC_FORMAT, value)
    )


def yes_no(value: Column) -> Column:
    return F.when(value, F.lit("YES")).otherwise(F.lit("NO"))
