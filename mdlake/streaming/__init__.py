"""Incremental (Structured Streaming) form of the batch jobs."""
