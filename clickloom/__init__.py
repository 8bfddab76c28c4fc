"""Spark-native article and interaction analytics with batch and streaming recommendation."""
