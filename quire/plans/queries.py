"""Queries of the core operators, and the SQL that checks them."""

from __future__ import annotations

from quire.plans import document_queries, drift_queries, section_queries, store_queries
from quire.plans.registry import Query

PARTS = (document_queries.REGISTRY, section_queries.REGISTRY, store_queries.REGISTRY, drift_queries.REGISTRY)


def queries() -> dict[str, Query]:
    return {name: f for part in PARTS for name, f in part.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.sql.items()}
