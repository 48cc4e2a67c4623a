"""Structured Streaming: sources, session windows, sinks."""
