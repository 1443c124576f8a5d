"""Incremental Bronze ingest with Structured Streaming."""
