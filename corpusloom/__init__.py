"""Spark-native corpus and tabular analytics: every operator is DataFrame in, DataFrame out."""
