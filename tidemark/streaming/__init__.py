"""Structured Streaming ingest of ping files."""
