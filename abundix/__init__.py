"""Spark-native profiling and comparison of abundance tables."""
