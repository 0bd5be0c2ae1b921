"""Spark-native collection, enrichment, de-duplication and ranking of news-like documents."""

__version__ = "0.1.0"
