"""tripflow: a PySpark-native warehouse for trip-style event data."""

__version__ = "0.1.0"
