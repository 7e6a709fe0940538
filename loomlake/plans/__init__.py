"""Queries over the driver's tables, one or more for each operator family, with equal SQL."""

from . import audit_queries, graph_queries, ingestion_queries, matching_queries, proxy_queries, review_queries  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
