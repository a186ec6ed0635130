"""Registered queries with the SQL that must give the same rows."""

from catalog import jobs, landing, page_queries, relations, rows  # noqa: F401
from catalog.registry import ORACLES, QUERIES  # noqa: F401
