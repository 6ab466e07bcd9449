"""Structured Streaming variants of batch jobs (optional re-aims R1, R2)."""
