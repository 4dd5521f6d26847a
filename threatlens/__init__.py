"""Security-log analytics on Spark: ingestion, detection, alerting, threat profiles."""
