"""Spark-native analytics for solar-park telemetry."""

__version__ = "0.1.0"
