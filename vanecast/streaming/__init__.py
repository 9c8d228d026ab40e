"""Structured Streaming twins of the batch jobs."""
