"""Composed queries over the fixture tables and their oracle SQL."""

from propensa.plans.registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
