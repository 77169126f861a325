"""Spark-native workforce and recruiting analytics: DataFrames in, DataFrames out."""
