"""Spark-native curation and analytics of text corpora: DataFrame-to-DataFrame operators."""

__version__ = "0.1.0"
