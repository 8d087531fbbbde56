"""Spark-native streaming joins, event-time aggregation and message delivery."""
