"""Spark-native operators for building labelled text corpora."""
