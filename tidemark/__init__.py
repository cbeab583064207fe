"""Spark-native analytics for market-microstructure time series."""

__version__ = "0.1.0"
