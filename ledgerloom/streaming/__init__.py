"""Incremental click ingest with Structured Streaming."""
