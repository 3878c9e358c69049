"""Incremental ingest with Structured Streaming (ST1)."""
