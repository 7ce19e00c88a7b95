"""Spark-native web page to sentence corpus engine."""
