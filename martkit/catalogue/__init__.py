"""Registered queries over the given tables, each with the SQL to check it by."""

from martkit.catalogue import daily, kept, oracles, queries

QUERIES = {**queries.QUERIES, **daily.QUERIES, **kept.QUERIES}
ORACLES = {**oracles.ORACLES, **daily.ORACLES, **kept.ORACLES}

__all__ = ["ORACLES", "QUERIES"]
