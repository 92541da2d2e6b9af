"""Tessella: a Spark-native engine for retrieval corpora and training-data preparation."""

__version__ = "0.1.0"
