"""Spark-native engine for turning collections of documents into structured, evidence-backed records."""
