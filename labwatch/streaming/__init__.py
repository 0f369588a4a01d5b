"""Incremental ingestion and event-time aggregation."""
