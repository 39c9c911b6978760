"""Structured Streaming jobs: ingest, detect, store, statistics."""
