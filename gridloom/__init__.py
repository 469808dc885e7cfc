"""Spark-native analytics for high-frequency meter time series."""
