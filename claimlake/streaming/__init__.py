"""Structured Streaming jobs: continuous landing ingest and running journey metrics."""
