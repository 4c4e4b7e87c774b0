"""Spark-native analytics for 3-D point clouds and semantic city models."""
