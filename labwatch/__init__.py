"""Spark-native analytics for laboratory test surveillance."""
