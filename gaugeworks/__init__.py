"""Spark-first warehouse and analytics for equipment telemetry."""
