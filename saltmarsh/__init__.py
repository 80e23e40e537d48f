"""Spark-native catalogue ingestion, validation and enrichment engine."""
