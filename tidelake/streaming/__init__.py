"""Continuous collection with Structured Streaming."""
