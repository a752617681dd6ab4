"""All registered queries of the legal-text engine and their SQL counterparts."""

from __future__ import annotations

from . import names, texts, citations, judgments, validity, graph, indexed, scale, streams, tables, sqlcalls  # noqa: F401, I001
from .base import CASES, ORACLE_SQL, QUERIES

__all__ = ["CASES", "ORACLE_SQL", "QUERIES"]
