"""Millrace: a Spark-native engine for ingesting entity records and curating text corpora."""
