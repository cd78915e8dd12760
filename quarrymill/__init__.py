"""Spark-native corpus preparation and retrieval engine."""
