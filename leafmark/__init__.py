"""A PySpark-native engine for turning noisy, multi-source document text into a cited, measured passage corpus."""
