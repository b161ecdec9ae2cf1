"""Spark-native analytics over corpora of scientific articles."""

__version__ = "0.1.0"
