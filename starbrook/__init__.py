"""Clickstream star schema on Spark: ingestion, upserts, reports, quality, retention and alerts."""
