"""Talus: a PySpark-native engine for change-tracked, multilingual text records."""
