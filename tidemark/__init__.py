"""Tidemark: a PySpark-native engine for versioned order events and their warehouse."""
