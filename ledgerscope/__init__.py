"""Spark-native engine for public-records data."""
