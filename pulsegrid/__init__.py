"""Spark-native operators for physiological time series."""

__version__ = "0.1.0"
