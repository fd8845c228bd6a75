"""Registered queries over the given tables."""

from termweave.plans import eval_queries, graph_queries, index_queries, rank_queries, text_queries  # noqa: F401
from termweave.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
