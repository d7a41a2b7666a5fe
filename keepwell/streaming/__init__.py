"""Structured Streaming ingestion and alerting."""
