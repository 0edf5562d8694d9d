"""Spark-native analytics for delivery-fleet events."""
