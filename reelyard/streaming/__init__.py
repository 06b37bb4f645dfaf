"""Incremental change application with Structured Streaming."""
