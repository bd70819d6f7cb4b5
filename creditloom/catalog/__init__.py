"""Runnable queries over the given tables, each with a DuckDB text where SQL can express it."""

from creditloom.catalog import (  # noqa: F401
    chain_queries,
    feature_queries,
    model_queries,
    name_queries,
    panel_queries,
    profile_queries,
    range_queries,
    score_queries,
    stream_queries,
)
from creditloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
