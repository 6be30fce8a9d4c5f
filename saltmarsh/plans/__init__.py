"""The catalog of named queries."""

from . import aggregates, documents, models, retrieval, statistics, streams, tables, windows  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
