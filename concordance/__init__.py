"""Spark-native engine that reconciles what several recognisers say about the same item."""
