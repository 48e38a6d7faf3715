"""All named queries."""

from gripline.plans import motion_queries, source_queries, table_queries, trace_queries  # noqa: F401
from gripline.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
