"""Text sources: edge lists, adjacency records and ranked records."""

from linkrank.sources.edges import (
    check_edges,
    parse_edges,
    read_edges,
    reject_counts,
    split_checked,
)
from linkrank.sources.records import (
    POSITION,
    check_records,
    lines_in_order,
    number_parts,
    parse_adjacency,
    parse_ranked,
    parse_records,
    ranked_nodes_of,
    read_adjacency,
    read_parts,
    read_ranked,
)

__all__ = [
    "POSITION",
    "check_edges",
    "check_records",
    "lines_in_order",
    "number_parts",
    "parse_adjacency",
    "parse_edges",
    "parse_ranked",
    "parse_records",
    "ranked_nodes_of",
    "read_adjacency",
    "read_edges",
    "read_parts",
    "read_ranked",
    "reject_counts",
    "split_checked",
]
