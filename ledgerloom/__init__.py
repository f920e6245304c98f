"""Spark-native entity and click analytics: DataFrame plans built from reusable operators."""
