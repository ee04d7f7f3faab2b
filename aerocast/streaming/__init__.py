"""Structured Streaming ingest of flight-board batch messages."""
