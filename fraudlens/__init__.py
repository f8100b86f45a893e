"""Spark-native transaction-risk analytics: DataFrame in, DataFrame out."""
