"""Registered queries and their comparison SQL."""

from . import (  # noqa: F401
    candle_queries,
    job_queries,
    key_queries,
    monitoring_queries,
    series_queries,
)
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
