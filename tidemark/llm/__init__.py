"""Operators for training-data pipelines, with their queries and comparison SQL."""

from .queries import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
