"""Structured Streaming forms of the monitoring profiles."""
