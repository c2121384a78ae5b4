"""Spark-native analytics over event and result tables."""
