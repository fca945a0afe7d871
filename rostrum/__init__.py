"""Rostrum: a Spark-native analytics engine for catalogs of recorded meetings."""

__version__ = "0.1.0"
