"""Structured Streaming: drops as they complete, run status as it changes."""
