"""Append-only streaming ingest."""
