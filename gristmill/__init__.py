"""Spark-native curation and analytics of text and code corpora."""

__version__ = "0.1.0"
