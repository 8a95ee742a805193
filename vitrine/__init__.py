"""Spark-native listing ETL and price analytics."""

__version__ = "0.1.0"
