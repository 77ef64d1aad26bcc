"""Incremental (repeated-batch) loads with Structured Streaming."""
