"""Incremental runs of the batch jobs with Structured Streaming."""
