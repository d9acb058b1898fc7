"""Tabular risk scoring on Spark: validation, as-of features, exact ranking metrics,
drift monitoring and service telemetry over tables and streams."""

__version__ = "0.1.0"
