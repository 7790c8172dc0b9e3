"""Structured Streaming forms of the monthly ingest."""
