"""Imports every query module of this folder, so that its registry is full."""

from shelfspark.llm import audit_queries, model_queries, packing_queries, page_queries, pair_queries, scan_queries  # noqa: F401
from shelfspark.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
