"""Spark-native job-postings engine."""
