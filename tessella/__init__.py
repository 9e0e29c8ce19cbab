"""Spark-native curation of supervised text datasets."""
