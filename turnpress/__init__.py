"""Spark-native preparation of conversational training data."""
