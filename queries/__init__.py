"""Registered queries: graphs made from the test tables, the operators run on them, and matching SQL."""

from queries.oracle import oracle_sql
from queries.registry import queries

__all__ = ["oracle_sql", "queries"]
