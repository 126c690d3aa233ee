"""Registered queries, each with the SQL that states the same result where SQL can."""

from .registry import ORACLES, QUERIES

from . import relational, scalars, plans, features, neighbors, models  # noqa: E402,F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
