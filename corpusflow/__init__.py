"""Spark-native content curation and text analytics."""
