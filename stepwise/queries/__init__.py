"""All runnable queries; importing a module registers its queries."""

from stepwise.queries import checks, claims, functions, jobs, joins, merges, ordered, rows, streams, summaries  # noqa: F401
from stepwise.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
