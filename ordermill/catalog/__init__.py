"""Registered queries: one Spark callable and, where SQL can say it, one oracle."""
from . import elt, modelling, quality, questions, relational, sources_sinks  # noqa: F401
from .base import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
