"""Spark-native ingestion and analytics of fixed-width record drops."""

__version__ = "0.1.0"
