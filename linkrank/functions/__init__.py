"""Column functions shared by the readers, operators and sinks."""

from linkrank.functions.formats import fixed, scientific, yes_no
from linkrank.functions.sums import small_sum, steady_sum
from linkrank.functions.text import (
    integer_order,
    is_integer,
    neighbor_list,
    parse_double,
    strip,
    with_once,
)

__all__ = [
    "fixed",
    "integer_order",
    "is_integer",
    "neighbor_list",
    "parse_double",
    "scientific",
    "small_sum",
    "steady_sum",
    "strip",
    "with_once",
    "yes_no",
]
