"""marlspan: a PySpark-native engine for curating image-and-code training data."""
