"""Spark-native analytics for classified-listing data."""

__version__ = "0.1.0"
