"""Incremental batch driver and Structured Streaming jobs."""
