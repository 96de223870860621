"""A PySpark-native engine for crop-mapping reference data."""
