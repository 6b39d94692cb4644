"""textloom: a PySpark-native engine for noisy-text preparation, translation and quality work."""
