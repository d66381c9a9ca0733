"""Spark-native analytics on activity logs, labelled messages and price series."""

__version__ = "0.1.0"
