"""Sensor telemetry analytics expressed as Spark DataFrame, SQL and streaming jobs."""
