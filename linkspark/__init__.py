"""A PySpark-native engine for entity resolution."""
