"""Candle features, labels and quality checks on PySpark."""
