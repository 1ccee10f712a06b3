"""Incremental loads: batch and Structured Streaming forms."""
