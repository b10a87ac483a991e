"""Structured Streaming sources, alert and commission queries, validation and sinks."""
