"""eventloom: a Spark-native engine for event fusion, validation, scoring and rollups."""

__version__ = "0.1.0"
