"""Every registered query."""

from . import (  # noqa: F401  (importing registers the queries)
    clean_queries,
    feature_queries,
    model_queries,
    source_queries,
    stats_queries,
    text_queries,
)
from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
