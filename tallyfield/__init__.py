"""Spark-native operators for customer, clinical and sensor analytics."""
