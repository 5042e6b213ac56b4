"""Spark-native engine for page-split, OCR-damaged tables of official gazettes."""
