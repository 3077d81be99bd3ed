"""Queries over the test tables, each with the SQL it must agree with where SQL can say it."""

from corpusloom.queries.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
