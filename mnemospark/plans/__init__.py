"""Compositions of operators and the registered queries."""

from mnemospark.plans import corpus_queries, graph_queries, memory_queries, retrieval_queries, table_queries  # noqa: F401
from mnemospark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
