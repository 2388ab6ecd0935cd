"""Spark-native dataset generation and text analytics."""
