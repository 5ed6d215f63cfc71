"""All registered queries; importing the package fills the registry."""

from . import (  # noqa: F401
    decision_queries, feature_queries, fraud_queries, metric_queries, model_queries, quality_queries, source_queries,
    store_queries, stream_queries, text_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
