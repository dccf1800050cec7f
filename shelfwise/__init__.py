"""Retail recommendation, feature engineering and telemetry analytics as Spark jobs."""
