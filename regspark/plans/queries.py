"""Registered queries: one or more for each operator, on the given tables, with the SQL that must agree."""

from __future__ import annotations

from . import derived_queries, quality_queries, source_queries, table_queries  # noqa: F401
