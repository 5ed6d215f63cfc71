"""Spark-first decision analytics: features, labels, metrics, drift, allocation, retrieval."""
