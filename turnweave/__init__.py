"""Spark-native analytics over time-aligned speech evidence."""
