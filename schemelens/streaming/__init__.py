"""Structured Streaming forms of the change-driven jobs."""
