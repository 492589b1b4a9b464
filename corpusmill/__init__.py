"""Spark-native corpus curation: text functions, merges, incremental builds and review folds on DataFrames."""
