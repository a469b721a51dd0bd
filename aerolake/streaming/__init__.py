"""Structured Streaming forms of ingest and of the daily aggregate."""
