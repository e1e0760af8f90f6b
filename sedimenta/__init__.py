"""Spark-native curation and analytics of instruction, code and document corpora."""
