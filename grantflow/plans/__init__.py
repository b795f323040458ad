"""Registered queries over the given tables, each with its SQL twin where one exists."""

from . import queries_changes, queries_graph, queries_integrity, queries_metrics, queries_sources  # noqa: F401
from .catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
