"""Spark-native statistical-genetics analytics."""
