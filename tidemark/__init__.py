"""Spark-native analytics for ordered, per-key event streams and text corpora."""

__version__ = "0.1.0"
