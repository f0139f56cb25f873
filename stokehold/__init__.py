"""Spark-native time-series quality and anomaly analytics."""

__version__ = "0.1.0"
