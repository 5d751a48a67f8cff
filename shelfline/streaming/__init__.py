"""Structured Streaming ingest and refresh."""
