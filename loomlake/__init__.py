"""Spark-native source ingestion, matching and release analytics."""
