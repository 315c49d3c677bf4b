"""Spark-native de-identification, quality control and change capture."""

__version__ = "0.1.0"
