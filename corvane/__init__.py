"""Spark-native analytics over linked evidence records and text corpora."""
