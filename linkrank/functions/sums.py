"""Sums of doubles that do not depend on the order of additions.

A double is cut at two fixed binary places into whole numbers, which are added up exactly in 64 bits however the rows
are dealt, and the two sums are put together once. So every partitioning, every rerun and every task done twice gives the
same bits. What is lost lies below the second place, 2**-78 of the unit, for each addend.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first place leaves room for totals up to 2**8, the second one for 2**40 addends.
HIGH_BITS = 55
LOW_BITS = 23
HIGH = 2.0**HIGH_BITS
LOW = 2.0 ** (HIGH_BITS + LOW_BITS)
#: Values of at least this size are not cut.
LARGEST = 2.0**7


def unit_for(total: float) -> float:
    """Power of two in which values are measured whose total is at most ``total``; 1 for shares of one rank."""
    return 2.0 ** max(0, ceil(log2(total / LARGEST))) if total > LARGEST else 1.0


def high_part(x: Column, unit: float = 1.0) -> Column:
    return F.floor(x * F.lit(HIGH / unit))


def low_part(x: Column, unit: float = 1.0) -> Column:
    """What the high part leaves; the products and the difference are exact."""
    scaled = x * F.lit(HIGH / unit)
    return F.floor((scaled - F.floor(scaled).cast("double")) * F.lit(2.0**LOW_BITS))


def put_together(high: Column, low: Column, unit: float = 1.0) -> Column:
    return high.cast("double") * F.lit(unit / HIGH) + low.cast("double") * F.lit(unit / LOW)


def total_of(high: int | None, low: int | None, unit: float = 1.0) -> float:
    """The same on the driver; a sum over no rows is 0."""
    return float(high or 0) * (unit / HIGH) + float(low or 0) * (unit / LOW)


def small_sum(x: Column, unit: float = 1.0) -> Column:
    """Sum of values from 0 on whose total is at most 2**7 units; far beyond that the job fails."""
    return put_together(F.sum(high_part(x, unit)), F.sum(low_part(x, unit)), unit)


def steady_sum(x: Column) -> Column:
    """Sum of any values. It is free of order where all of them are finite and, like their total, below 2**7 in size; else it is Spark's sum."""
    fits = F.abs(x) < LARGEST
    exact = put_together(F.try_sum(F.when(fits, high_part(x))), F.try_sum(F.when(fits, low_part(x))))
    return F.coalesce(F.when(F.count(x) == F.count_if(fits), exact), F.sum(x))
