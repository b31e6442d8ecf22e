"""Structured Streaming forms: ingestion, hourly statistics, deduplication, restated days."""
