"""Spark-native analytics over public land and building records, and over text corpora."""
