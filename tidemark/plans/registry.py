"""All queries of the library and their SQL."""

from __future__ import annotations

from tidemark.plans import page_queries as _pages  # noqa: F401  adds its queries
from tidemark.plans import table_queries as _tables  # noqa: F401  adds its queries
from tidemark.plans.queries import ORACLES, QUERIES, flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
