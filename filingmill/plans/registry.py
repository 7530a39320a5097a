"""Queries of the library's own operators, by name, with their SQL."""

from __future__ import annotations

from filingmill.plans.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
