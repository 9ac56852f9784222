"""Structured Streaming sources, sinks and stage runners."""
