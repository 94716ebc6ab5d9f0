"""Structured Streaming queries: bronze ingest, dedup, alerts, hourly windows."""
