"""Spark-native content curation engine."""
