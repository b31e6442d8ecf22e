"""Scans of raw telemetry and sinks of result tables."""
