"""Incremental ingest of landed page responses (Structured Streaming file source)."""
