"""Queries over the given tables, each with the SQL that must give the same rows."""

from quaylake.registry import landing, refining, reporting, storing  # noqa: F401  (registers)
from quaylake.registry.base import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
