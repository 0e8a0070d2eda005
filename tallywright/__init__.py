"""Spark-native engine for verifiable public-budget data."""
