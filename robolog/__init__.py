"""Spark-native analytics over recorded robot logs."""
