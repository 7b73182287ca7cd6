"""The operators bound to the given tables, each with its SQL."""

from bindings import cells, checks, feeds, files, journeys, siting, streams, turnstile  # noqa: F401
from bindings.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
