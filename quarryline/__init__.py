"""Quarryline: a PySpark-native engine for image-to-polygon analytics and corpus preparation."""
