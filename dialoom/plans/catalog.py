"""All queries: importing the modules registers what is in them."""

from dialoom.plans import case_queries, file_queries, layer_queries, people_queries, queries
from dialoom.plans.registry import QUERIES, SQL

MODULES = (queries, case_queries, people_queries, layer_queries, file_queries)
__all__ = ["MODULES", "QUERIES", "SQL"]
