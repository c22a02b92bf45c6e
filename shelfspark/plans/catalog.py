"""Imports every query module, so that the registry is full."""

from shelfspark.plans import (  # noqa: F401
    booster_queries,
    forecast_queries,
    interval_queries,
    layout_queries,
    prepare_queries,
    quality_queries,
    run_queries,
    segment_queries,
    source_queries,
    stream_queries,
)
from shelfspark.plans.registry import ORACLES, QUERIES

SLOW = booster_queries.NAMES

__all__ = ["ORACLES", "QUERIES", "SLOW"]
