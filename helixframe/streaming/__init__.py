"""Incremental ingest and refresh with Structured Streaming."""
