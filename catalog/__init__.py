"""Registered queries: every operator over the provided tables, with the SQL that checks it."""

from catalog import (  # noqa: F401
    column_queries,
    flow_queries,
    job_queries,
    pool_queries,
    review_queries,
    score_queries,
    vector_queries,
)
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
