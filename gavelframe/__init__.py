"""Spark-native legal-text retrieval and analytics."""
