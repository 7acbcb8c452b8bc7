"""Structured Streaming re-aims of the scheduled jobs."""
