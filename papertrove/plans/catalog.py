"""All registered queries."""

from papertrove.plans import asset_queries, document_queries, scoring_queries, search_queries, table_queries  # noqa: F401
from papertrove.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
